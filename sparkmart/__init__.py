"""sparkmart: order-data analytics written as Spark DataFrame jobs.

Layers (all lazy DataFrame -> DataFrame functions, no global session):

* ``sources``   – scans of untyped files, driver tables, feeds, and sinks
* ``functions`` – scalar column expressions (dates, labels, money, text)
* ``operators`` – cleaning, dedup, mart, series, KPIs, metrics, forecasts
* ``streaming`` – micro-batch order ingestion
* ``plans``     – the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
