"""stridebase: race-result analytics on Spark, from raw files to star schema, marts and checks."""
