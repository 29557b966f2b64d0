"""Weftline: batch, table-version and stream operators as plain PySpark functions.

Every operator takes DataFrames and returns a DataFrame.  Nothing here parses, plans or
schedules: the functions describe the work with the DataFrame API and Spark runs it.
"""
