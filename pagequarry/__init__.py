"""Content-analytics operators on PySpark DataFrames."""
