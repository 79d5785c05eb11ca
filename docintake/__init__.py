"""Link and document intake as PySpark DataFrame and Structured Streaming jobs."""
