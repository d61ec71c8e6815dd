"""reelstats: rating analytics and recommendations as Spark DataFrame jobs.

Every operator is a function from DataFrames to DataFrames.  Sub-packages:

* ``sources``   - table scans, sinks and the fixture views over the driver tables
* ``functions`` - column expressions (label parsing, month keys, regex repair ...)
* ``operators`` - profiling, cleaning, statistics, coding/splits, item-CF, ALS,
                  evaluation, serving and dashboard datasets
* ``plans``     - the named query catalogue and its DuckDB oracle SQL
* ``streaming`` - incremental versions of the popularity statistics
"""

__version__ = "0.1.0"
