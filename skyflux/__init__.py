"""skyflux: Spark-native light-curve, alert-stream and truth-table analytics.

Every operator is a plain function ``DataFrame -> DataFrame`` parameterised by
column names, so it runs unchanged on survey tables and on derived test tables.
"""

__version__ = "0.1.0"
