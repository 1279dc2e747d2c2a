"""Config-driven metrics, data quality and history on Spark DataFrames."""
