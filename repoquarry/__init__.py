"""Repository-history analytics as PySpark DataFrame operators."""
