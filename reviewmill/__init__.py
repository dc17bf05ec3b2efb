"""Review analytics on Spark, for tables and streams."""
