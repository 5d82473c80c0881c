"""Derived tables, reports and checks."""
