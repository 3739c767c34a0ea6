"""Operators for training-data pipelines.

Nothing else in the library imports this package.  Every operator takes a
DataFrame and column names, returns a DataFrame, and keeps all intermediate
state in Spark or in the shared folder named by ``spark.checkpoint.dir``.
"""
