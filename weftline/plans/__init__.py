"""Whole jobs built from the operators, and the queries that run them on the test tables."""
