"""Landed payloads, export files and link lists."""
