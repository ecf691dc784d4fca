"""Learning allocation and completion analytics as Spark DataFrame jobs."""
