"""tidemark: incremental table synchronisation and reconciliation on Spark.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame, written with Spark's own column functions, joins, windows and
streaming primitives.  See README.md for the operator map.
"""

__version__ = "0.1.0"
