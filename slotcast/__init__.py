"""slotcast: slot-level retail demand analytics and forecasting on Spark.

Subpackages
-----------
sources    table readers, adapters from the driver tables, fixed dimension data, sinks
functions  column expressions (time keys, calendar flags, rounding)
operators  DataFrame -> DataFrame building blocks (clean, grid, rollup, smooth, ...)
plans      the registered queries and their DuckDB oracle SQL
streaming  the same slot aggregation on a file stream
"""

__version__ = "0.1.0"
