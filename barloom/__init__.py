"""Market-data analytics as plain PySpark DataFrame functions."""
