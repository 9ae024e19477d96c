"""Spark-native lakehouse for monthly trip-record files.

Every public entry point takes and returns Spark DataFrames; see ``README.md``
for a tour and ``meterlake.plans.job`` for the complete run.
"""

__version__ = "0.1.0"
