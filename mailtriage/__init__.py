"""Mail-risk analytics as Spark DataFrame jobs."""
