"""Store-level retail sales analytics as PySpark DataFrame operators."""
