"""Operators of a training-data pipeline, each on Spark DataFrames.

Nothing else in the library imports this package; ``queries`` registers
one query per operator.
"""
