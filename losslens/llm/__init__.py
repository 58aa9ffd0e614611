"""Operators of a training-data pipeline on Spark DataFrames.

One module per operator; ``queries`` registers one thin query per operator
and holds their SQL twins.  Nothing else in the library imports this package.
"""
