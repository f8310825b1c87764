"""Community growth analytics as PySpark DataFrame plans."""
