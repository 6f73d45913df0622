"""KPI read models over the series tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY, div_round_half_up
from .series import GLOBAL


def _cents(c):
    return (F.col(c) * 100).cast("bigint")


def kpi_totals(daily: DataFrame) -> DataFrame:
    """Total revenue, total orders, mean daily revenue (rounded half away from zero)."""
    a = daily.agg(F.sum(_cents("y")).alias("_c"), F.sum("n_orders").alias("n_orders"),
                  F.count(F.lit(1)).alias("_n"))
    return a.filter(F.col("_n") > 0).select(
        div_round_half_up(F.col("_c"), F.lit(100)).alias("ca_total"),
        F.col("n_orders").cast("bigint").alias("nb_commandes"),
        div_round_half_up(F.col("_c"), F.col("_n") * 100).alias("ca_moyen_jour"))


def revenue_by_service(by_service: DataFrame, label: str = "service") -> DataFrame:
    return (by_service.groupBy(label)
            .agg(F.sum("y").cast(MONEY).alias("y"), F.sum("n_orders").alias("n_orders")))


def top_service(by_service: DataFrame, label: str = "service") -> DataFrame:
    """Service with the largest revenue; ties go to the first name."""
    return (revenue_by_service(by_service, label)
            .orderBy(F.desc("y"), F.asc(label)).limit(1)
            .select(F.col(label).alias("top_service"), F.col("y").alias("top_y")))


def kpi_summary(series: DataFrame) -> DataFrame:
    """One KPI record from the long series table; empty input -> no row.

    Two aggregation levels (per series, then overall) instead of joining two
    one-row frames; the top label is ``min_by`` on (-revenue, name).
    """
    per = series.groupBy("series").agg(
        F.sum(_cents("y")).alias("_c"), F.sum("n_orders").alias("_o"),
        F.count(F.lit(1)).alias("_n"))
    is_g = F.col("series") == GLOBAL
    a = per.agg(
        F.sum(F.when(is_g, F.col("_c"))).alias("_c"),
        F.sum(F.when(is_g, F.col("_o"))).alias("_o"),
        F.sum(F.when(is_g, F.col("_n"))).alias("_n"),
        F.min_by(F.when(~is_g, F.col("series")),
                 F.when(~is_g, F.struct((-F.col("_c")).alias("a"), F.col("series").alias("b")))
                 ).alias("top_service"))
    return a.filter(F.col("_c").isNotNull()).select(
        div_round_half_up(F.col("_c"), F.lit(100)).alias("ca_total"),
        F.col("_o").cast("bigint").alias("nb_commandes"),
        div_round_half_up(F.col("_c"), F.col("_n") * 100).alias("ca_moyen_jour"),
        F.coalesce("top_service", F.lit("N/A")).alias("top_service"))


def kpi_delta(daily: DataFrame, n: int = 30) -> DataFrame:
    """Revenue of the last ``n`` rows vs the ``n`` rows before (rows, not days)."""
    last = daily.orderBy(F.desc("ds")).limit(2 * n)
    w = Window.orderBy(F.desc("ds"))  # at most 2n rows
    r = last.withColumn("_rn", F.row_number().over(w))
    a = r.agg(F.sum(F.when(F.col("_rn") <= n, F.col("y"))).cast(MONEY).alias("last_y"),
              F.sum(F.when(F.col("_rn") > n, F.col("y"))).cast(MONEY).alias("prev_y"))
    pct = F.round(F.try_divide((F.col("last_y") - F.col("prev_y")).cast("double") * 100,
                               F.col("prev_y").cast("double")), 1)
    return a.select("last_y", "prev_y", pct.alias("delta_pct"))


def revenue_share(by_service: DataFrame, label: str = "service") -> DataFrame:
    """Share of total revenue per service, in percent (1 digit)."""
    r = revenue_by_service(by_service, label)
    tot = F.sum("y").over(Window.partitionBy())  # one row per service: tiny
    return r.select(label, "y", F.round(F.col("y").cast("double") * 100 / tot.cast("double"), 1)
                    .alias("share_pct"))


def revenue_by_month(by_service: DataFrame, label: str = "service") -> DataFrame:
    return (by_service.groupBy(F.trunc("ds", "month").alias("month"), label)
            .agg(F.sum("y").cast(MONEY).alias("y"), F.sum("n_orders").alias("n_orders")))
