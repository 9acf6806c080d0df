"""Column functions and string similarities."""
