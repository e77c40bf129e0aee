"""Operators for large text corpora (training-data preparation) on Spark.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; ``queries`` derives the registered digests.
"""
