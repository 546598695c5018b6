"""Competition and market-snapshot analytics as PySpark DataFrame operators."""
