"""Sources and sinks: instrument master CSV, landed JSON responses, the
partitioned Parquet candle store."""
