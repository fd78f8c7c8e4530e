"""threadlens: discussion-forum analytics as Spark DataFrame jobs."""
