"""Scalar rules, all as Column expressions that stay inside the JVM."""
