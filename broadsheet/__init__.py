"""News and document analytics as DataFrame, Spark ML and Structured Streaming operators."""
