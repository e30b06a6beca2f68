"""Scans: raw CSV lines, cleaned CSV, stored tables, and sample data."""
