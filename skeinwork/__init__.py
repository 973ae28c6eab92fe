"""Skeinwork: a relational query vocabulary on PySpark's DataFrame and SQL APIs."""
