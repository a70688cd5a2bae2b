"""Order-event analytics as PySpark DataFrame and Structured Streaming jobs."""
