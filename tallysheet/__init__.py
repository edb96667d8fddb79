"""tallysheet: Spark-native operators for health-data staging and reporting warehouses.

Every operator is a ``DataFrame -> DataFrame`` function over built-in Spark
expressions; see README.md for the operator map and the scale design.
"""

__version__ = "0.1.0"
