"""weftline: DataFrame, SQL and Structured Streaming operators for PySpark."""
