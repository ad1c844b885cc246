"""Payment-outcome analytics on PySpark DataFrames."""
