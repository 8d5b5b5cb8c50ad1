"""Operators composed into jobs, and the catalogue of registered queries."""
