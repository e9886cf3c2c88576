"""Credit-risk scorecard analytics as PySpark DataFrame jobs."""
