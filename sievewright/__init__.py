"""Sievewright: a Spark-native data-quality and feature-store library.

Operators are functions from DataFrames to DataFrames, driven by frozen specs.
They build lazy plans only; the few that run a job say so in their docstring.
"""
