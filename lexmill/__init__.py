"""Parliamentary bill analytics as PySpark DataFrame jobs."""
