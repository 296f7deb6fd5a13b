"""Amberline: risk rating of operational records on Spark.

Clean, derive, score, train, tune, rate and report; every step takes and
returns DataFrames and has column names as parameters.
"""
