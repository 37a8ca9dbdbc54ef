"""Night-time-light analytics as composable PySpark DataFrame operators."""
