"""Whole runs, the demo records, the driver's queries and their SQL."""
