"""Climate time-series analytics as composable PySpark DataFrame transformations."""
