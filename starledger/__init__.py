"""starledger: a Spark-native spending-analytics lakehouse.

Operators take and return DataFrames; jobs compose them into the
bronze -> silver -> gold -> published pipeline.  Nothing here executes
work on the driver: the only driver-side values are row counts and
per-range offsets.
"""

__version__ = "0.1.0"
