"""Retail lakehouse analytics on PySpark: raw -> clean -> star schema -> reports."""
