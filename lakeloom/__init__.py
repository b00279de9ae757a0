"""A batch lakehouse engine and training-data operators on PySpark DataFrames."""
