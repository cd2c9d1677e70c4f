"""Probabilistic row and pair analytics, record linkage and training-data operators on PySpark."""
