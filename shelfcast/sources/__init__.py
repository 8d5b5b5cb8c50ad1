"""Scans and sinks, table schemas, and the retail tables."""
