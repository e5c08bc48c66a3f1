"""Social-data analytics as PySpark DataFrame functions."""
