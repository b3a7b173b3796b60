"""Fleet and trip analytics as PySpark DataFrame jobs."""
