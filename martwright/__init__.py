"""Layered (bronze, silver, gold, semantic) batch analytics on PySpark DataFrames."""
