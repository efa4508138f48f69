"""Checks, type inference and import reports."""
