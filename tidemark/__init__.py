"""Product and revenue analytics as PySpark DataFrame operators."""
