"""Retail catalogue analytics on PySpark: readers, column functions, operators, change data capture and streams."""
