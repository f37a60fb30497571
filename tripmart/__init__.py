"""Trip analytics on PySpark: landing, staging, dimension and fact tables."""
