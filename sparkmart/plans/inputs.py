"""Series inputs built from the star-schema tables (and their SQL twins).

Concept mapping: invoice = ``orders`` (one date per order), invoice line =
``lineitem``, service of a line = ``part.p_type``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series as S
from ..sources.tables import read_table, table_path, tasks_for


def daily(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
    return S.daily_series(o, li, inv_key="o_orderkey", inv_date="o_orderdate",
                          line_key="l_orderkey", amount="l_extendedprice")


def by_service(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice")
    p = read_table(spark, sf, "part", "p_partkey", "p_type")
    lines = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_extendedprice", p.p_type.alias("service"))
    return S.daily_series(o, lines, inv_key="o_orderkey", inv_date="o_orderdate",
                          line_key="l_orderkey", amount="l_extendedprice", by="service",
                          tasks=tasks_for(spark, table_path(sf, "lineitem")))


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Long series table ``(series, ds, y, n_orders)``: overall + per service, one pass."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice")
    p = read_table(spark, sf, "part", "p_partkey", "p_type")
    lines = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_extendedprice", p.p_type.alias("service"))
    return S.series_one_pass(o, lines, inv_key="o_orderkey", inv_date="o_orderdate",
                             line_key="l_orderkey", amount="l_extendedprice", label="service",
                             tasks=tasks_for(spark, table_path(sf, "lineitem")))


def series_table(spark: SparkSession, sf: str) -> DataFrame:
    """The published long series table of the session's store."""
    from .mart_store import Store

    return Store.of(spark, sf).series()


def stored_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The overall series: one partition of the store."""
    return series_table(spark, sf).where(F.col("series") == S.GLOBAL).drop("series")


def stored_by_service(spark: SparkSession, sf: str) -> DataFrame:
    return series_table(spark, sf).where(F.col("series") != S.GLOBAL).withColumnRenamed("series", "service")


DAILY_SQL = """
SELECT CAST(o_orderdate AS DATE) AS ds,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS y,
       COUNT(DISTINCT o_orderkey) AS n_orders
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY 1
"""

BY_SERVICE_SQL = """
SELECT CAST(o_orderdate AS DATE) AS ds, p_type AS service,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS y,
       COUNT(DISTINCT o_orderkey) AS n_orders
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2
"""

SERIES_SQL = f"""
SELECT 'global' AS series, ds, y, n_orders FROM ({DAILY_SQL}) g
UNION ALL
SELECT service AS series, ds, y, n_orders FROM ({BY_SERVICE_SQL}) s
"""

SERIES_CTES = [("daily", DAILY_SQL), ("by_service", BY_SERVICE_SQL), ("series", SERIES_SQL)]
