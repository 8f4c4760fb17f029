"""riskframe: Spark-native credit-risk analytics.

Every operator takes and returns DataFrames and is built from Spark SQL
built-ins, windows, joins and Spark ML; nothing is collected to the driver
except bounded metadata (a handful of edges, one-row aggregates).
"""

__version__ = "0.1.0"
