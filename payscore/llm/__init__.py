"""Operators on text corpora: training-data preparation on Spark.

Nothing else in the library imports this subpackage.
"""
