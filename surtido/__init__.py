"""Retail sales analytics and demand planning on PySpark DataFrames."""
