"""Shopgrain: retail data cleaning, profiling, loading and reporting on Spark.

Every operator takes DataFrames and column names and returns DataFrames; the
caller owns the ``SparkSession`` and its settings.
"""
