"""Retail-banking warehouse on PySpark: bronze, silver and gold layers as DataFrame operators."""
