"""Operators on tables of records, pairs and results."""
