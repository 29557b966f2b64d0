"""Column functions: code names, text tests, units."""
