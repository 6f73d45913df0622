"""Revenue series and the read models built on them.

Series are long tables ``(series, ds, y, n_orders)``; the overall series is
``series = 'global'``.  Amounts are ``decimal(38,2)`` so sums do not depend on
the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY
from ..functions.vocab import MONTH_MIN_DAYS, TRAILING_DAYS

GLOBAL = "global"


def _per_invoice(lines: DataFrame, key: str, amount: str, by: list[str], tasks: int | None = None) -> DataFrame:
    """Sums per invoice (and label), partitioned by the invoice key alone.

    Without labels the sums are partial before the only exchange.  With labels the
    lines are dealt by invoice once, over ``tasks`` tasks where that is given; the sums per
    (invoice, label) and the join to the invoices both need no other exchange then.
    """
    rows = lines.select(key, *by, F.col(amount).cast("decimal(18,2)").alias("_a"))
    if by:
        rows = rows.repartition(tasks, F.col(key)) if tasks else rows.repartition(F.col(key))
    return rows.groupBy(key, *by).agg(F.sum("_a").alias("_y"))


def daily_series(invoices: DataFrame, lines: DataFrame, *, inv_key: str, inv_date: str,
                 line_key: str, amount: str, by: str | None = None, tasks: int | None = None) -> DataFrame:
    """Revenue and distinct invoices per day (optionally per ``by`` label).

    Invoice ⋈ line is inner (an invoice without line counts nowhere).  Each
    invoice has one date, so after summing lines per (invoice[, label]) a plain
    ``count`` per day equals ``COUNT(DISTINCT invoice)`` without a distinct
    aggregate.
    """
    extra = [by] if by else []
    per_inv = _per_invoice(lines, line_key, amount, extra, tasks)
    inv = invoices.select(F.col(inv_key).alias(line_key), F.to_date(inv_date).alias("ds"))
    return (per_inv.join(inv, line_key).groupBy("ds", *extra)
            .agg(F.sum("_y").cast(MONEY).alias("y"), F.count(F.lit(1)).alias("n_orders")))


def series_one_pass(invoices: DataFrame, lines: DataFrame, *, inv_key: str, inv_date: str,
                    line_key: str, amount: str, label: str, tasks: int | None = None) -> DataFrame:
    """Overall and per-label daily series from one pass and one exchange of the lines.

    Lines are summed per (invoice, label); an invoice's sums (at most one for each
    label) and their total are then exploded into its series, so ``count`` per
    series and day is the number of distinct invoices.  Lines without a label count
    in the overall series only.
    """
    per = (_per_invoice(lines.withColumnRenamed(label, "series"), line_key, amount, ["series"], tasks).groupBy(line_key)
           .agg(F.collect_list(F.when(F.col("series").isNotNull(), F.struct("series", "_y"))).alias("_parts"), F.sum("_y").alias("_y")))
    inv = invoices.select(F.col(inv_key).alias(line_key), F.to_date(inv_date).alias("ds"))
    whole = F.array(F.struct(F.lit(GLOBAL).alias("series"), F.col("_y")))
    return (per.join(inv, line_key).select("ds", F.explode(F.concat(whole, "_parts")).alias("_s"))
            .groupBy(F.col("_s.series").alias("series"), "ds")
            .agg(F.sum("_s._y").cast(MONEY).alias("y"), F.count(F.lit(1)).alias("n_orders")))


def series_profile(series: DataFrame) -> DataFrame:
    """First/last date, calendar span, observations and density per series."""
    agg = series.groupBy("series").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n_obs"))
    span = F.datediff("last_ds", "first_ds")
    return agg.select(
        "series", "first_ds", "last_ds", span.cast("bigint").alias("span_days"), "n_obs",
        F.round(F.col("n_obs") / F.greatest(span, F.lit(1)).cast("double"), 4).alias("density"))


def trailing_history(series: DataFrame, days: int = TRAILING_DAYS) -> DataFrame:
    """Rows within ``days`` calendar days of each series' last date (inclusive)."""
    w = Window.partitionBy("series")
    return (series.withColumn("_max", F.max("ds").over(w))
            .filter(F.col("ds") >= F.date_sub("_max", days)).drop("_max"))


def month_rollup(series: DataFrame) -> DataFrame:
    return (series.groupBy("series", F.trunc("ds", "month").alias("month"))
            .agg(F.sum("y").cast(MONEY).alias("y"), F.count(F.lit(1)).alias("n_days")))


def keep_full_months(rollup: DataFrame, min_days: int = MONTH_MIN_DAYS,
                     count_col: str = "n_days") -> DataFrame:
    """Drop months with fewer than ``min_days`` days, unless that empties the series."""
    w = Window.partitionBy("series")
    mx = F.max(count_col).over(w)
    return (rollup.withColumn("_mx", mx)
            .filter((F.col(count_col) >= min_days) | (F.col("_mx") < min_days)).drop("_mx"))


def excluded_months(rollup: DataFrame, min_days: int = MONTH_MIN_DAYS,
                    count_col: str = "n_days") -> DataFrame:
    """The months :func:`keep_full_months` removes (reported beside the chart)."""
    w = Window.partitionBy("series")
    return (rollup.withColumn("_mx", F.max(count_col).over(w))
            .filter((F.col(count_col) < min_days) & (F.col("_mx") >= min_days)).drop("_mx"))
