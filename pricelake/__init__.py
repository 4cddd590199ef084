"""pricelake: a retail price-intelligence lakehouse on PySpark DataFrames."""
