"""Drift monitoring: hold out the last calendar days, measure, classify.

The validation window counts calendar days back from each series' last date, as a
series holds active days only.  The reference forecast looks back whole weeks into the
training days; where that finds nothing (from the 29th day on) the day does not enter
the ratio, and the number of compared days stands beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY, round_half_up
from ..functions.vocab import DRIFT_ERROR, DRIFT_MIN_POINTS, DRIFT_WARN, DRIFT_WINDOW_DAYS
from ..sources import versions as V
from .evaluation import seasonal_naive
from .series import GLOBAL

MIN_VALIDATION_ROWS = 5
SHORT_HISTORY_DAYS = 365
LOW_DENSITY = 0.5


def profile(series: DataFrame, window: int = DRIFT_WINDOW_DAYS) -> DataFrame:
    """Per series: first/last day, split date, span and observation counts."""
    p = series.groupBy("series").agg(F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
                                     F.count(F.lit(1)).alias("n_obs_total"))
    return p.select("*", F.date_sub("last_ds", window).alias("split_ds"),
                    F.datediff("last_ds", "first_ds").alias("span_days"))


def drift_split(series: DataFrame, window: int = DRIFT_WINDOW_DAYS) -> DataFrame:
    """Label each day ``train`` (``ds <= last - window``) or ``validation``."""
    w = Window.partitionBy("series")
    split = F.date_sub(F.max("ds").over(w), window)
    return series.select("series", "ds", "y",
                         F.when(F.col("ds") <= split, "train").otherwise("validation").alias("split"))


def persistence_at_split(series: DataFrame, window: int = DRIFT_WINDOW_DAYS) -> DataFrame:
    """Stand-in validation forecast: the last training value, on every validation day."""
    s = drift_split(series, window)
    last_train = (s.filter(F.col("split") == "train").groupBy("series")
                  .agg(F.max_by("y", "ds").cast(MONEY).alias("yhat")))
    val = s.filter(F.col("split") == "validation").select("series", "ds")
    return val.join(last_train, "series")


def drift_measures(series: DataFrame, forecasts: DataFrame,
                   window: int = DRIFT_WINDOW_DAYS) -> DataFrame:
    """One record per series: MAE, MAPE, RelMAE vs the weekly naive, counts.

    ``forecasts``: ``(series, ds, yhat)`` from a model fitted on the training
    days only.  A series is ``skipped`` when its span is under three windows
    or the window holds fewer than 5 observations.
    """
    prof = profile(series, window)
    val = (series.join(prof.select("series", "split_ds"), "series")
           .filter(F.col("ds") > F.col("split_ds"))
           .select("series", "split_ds", "ds", F.col("y").cast(MONEY).alias("y")))
    naive = seasonal_naive(series, val.select("series", "split_ds", "ds"), bound="split_ds")
    # a money forecast keeps the errors exact (sums of decimals); a model's
    # double forecast makes them doubles
    fc = forecasts.select("series", "ds", "yhat")
    v = val.join(fc, ["series", "ds"], "left").join(naive, ["series", "split_ds", "ds"], "left")
    y = F.col("y")
    err = F.abs(y - F.col("yhat"))
    has_ref = F.col("naive_y").isNotNull() & F.col("yhat").isNotNull()  # days with both forecasts

    def mean(c):
        return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))

    a = v.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_obs"),
        mean(err).alias("mae"),
        F.avg(F.when(y != 0, err.cast("double") / F.abs(y).cast("double"))).alias("_mape"),
        mean(F.when(has_ref, err)).alias("_mae_m"),
        mean(F.when(has_ref, F.abs(y - F.col("naive_y")))).alias("_mae_n"),
        F.sum(has_ref.cast("int")).cast("bigint").alias("n_relmae"))
    relmae = (F.when(F.col("n_relmae") == 0, F.lit(None).cast("double"))
              .when(F.col("_mae_n") == 0, F.lit(float("inf")))
              .otherwise(F.try_divide(F.col("_mae_m"), F.col("_mae_n"))))
    out = prof.join(a, "series", "left")
    n_obs = F.coalesce("n_obs", F.lit(0).cast("bigint"))
    skipped = (F.col("span_days") < 3 * window) | (n_obs < MIN_VALIDATION_ROWS)
    reason = (F.when(F.col("span_days") < 3 * window, F.lit("history too short"))
              .when(n_obs < MIN_VALIDATION_ROWS, F.lit("too few validation observations")))
    measured = ~skipped
    return out.select(
        "series",
        F.when(skipped, "skipped").otherwise("measured").alias("status"),
        reason.alias("detail"),
        n_obs.alias("n_obs"),
        F.lit(window).alias("n_days"),
        F.when(measured, round_half_up("mae", 2)).alias("mae"),
        F.when(measured, round_half_up(F.col("_mape") * 100, 2)).alias("mape_pct"),
        F.when(measured, round_half_up(relmae, 4)).alias("relmae"),
        F.when(measured, relmae).alias("relmae_raw"),
        F.when(measured, F.coalesce("n_relmae", F.lit(0).cast("bigint"))).alias("n_relmae"),
        F.col("span_days").cast("bigint").alias("span_days"),
        (F.col("span_days") < SHORT_HISTORY_DAYS).alias("short_history"),
        "n_obs_total",
        round_half_up(F.col("n_obs_total") / F.greatest(F.col("span_days"), F.lit(1)).cast("double"), 4)
        .alias("density"))


def drift_status(measures: DataFrame, error: float = DRIFT_ERROR, warn: float = DRIFT_WARN,
                 min_points: int = DRIFT_MIN_POINTS, overall: str = GLOBAL) -> DataFrame:
    """Classify each record; the run fails only on an error of the overall series.

    ``level``: skipped / insufficient_points / error / warning / ok.  A RelMAE
    at or above ``error`` is an error for the overall series and a warning for
    the others.  ``notes`` carries the notices on history and points.
    """
    r = F.col("relmae_raw")  # levels by the ratio itself; the rounded one is for display
    level = (F.when(F.col("status") == "skipped", "skipped")
             .when(F.col("n_relmae") < min_points, "insufficient_points")
             .when((r >= error) & (F.col("series") == overall), "error")
             .when(r >= warn, "warning")
             .otherwise("ok"))
    history = (F.when(F.col("status") == "skipped", F.col("detail"))
               .when(F.col("short_history"), F.lit("short history: yearly seasonality not identifiable"))
               .when(F.col("density") < LOW_DENSITY, F.lit("sparse history: seasonality estimated on few points")))
    few = F.when(level == "insufficient_points", F.lit("too few comparison points: threshold not applied"))
    s = measures.select("series", "relmae", "n_relmae", level.alias("level"), F.array_compact(F.array(history, few)).alias("notes"))
    # one row per series: a global window over this table is tiny
    failed = F.max((F.col("level") == "error").cast("int")).over(Window.partitionBy()) == 1
    return s.select("*", failed.alias("run_failed"))


def run_record(status: DataFrame, overall: str = GLOBAL) -> DataFrame:
    """One row on the run: what was measured, whether the overall series was evaluated, the outcome and the exit status.

    ``outcome``: ``drift`` (the overall series' error, exit status 1), ``no_drift``, or ``not_evaluated`` where
    the overall series has no level: no measure is not the same as no drift.
    """
    n = lambda c: F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("bigint")
    level, whole = F.col("level"), F.col("series") == overall
    evaluated = F.coalesce(F.bool_or(whole & level.isin("error", "warning", "ok")), F.lit(False))
    failed = F.coalesce(F.bool_or(level == "error"), F.lit(False))
    r = status.agg(n(level != "skipped").alias("n_measured"), n(level == "skipped").alias("n_skipped"), n(level == "insufficient_points").alias("n_too_few"),
                   n(level == "warning").alias("n_warnings"), evaluated.alias("overall_evaluated"), failed.alias("failed"))
    outcome = F.when(F.col("failed"), "drift").when(F.col("overall_evaluated"), "no_drift").otherwise("not_evaluated")
    return r.select("*", outcome.alias("outcome"), F.col("failed").cast("int").alias("exit_status"))


def record_run(measures: DataFrame, root: str) -> int:
    """Write the measures, levels and record of a run in one commit; the job's exit status."""
    spark, status = measures.sparkSession, drift_status(measures)
    change = V.merged(V.write_lot(measures, root, "mesures"), V.write_lot(status, root, "niveaux"))
    state = V.applied(V.snapshot(spark, root), change, 0)
    own = run_record(V.read(spark, root, state | {"parts": change["add"]}, "niveaux"))  # of this run's levels
    change = V.merged(change, V.write_lot(own.withColumn("execute_le", F.current_timestamp()), root, "executions"))
    status_ = own.first()["exit_status"]  # one row
    V.commit(spark, root, V.snapshot(spark, root), change)
    return status_
