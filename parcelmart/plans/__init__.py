"""Whole runs, the test-table mapping and the registered queries."""
