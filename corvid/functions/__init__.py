"""Scalar functions over text, URLs and dates: column expressions, with Python only where Spark has no primitive."""
