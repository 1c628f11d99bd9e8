"""News-and-price analytics as composable PySpark DataFrame operators."""
