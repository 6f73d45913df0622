"""Rolling-origin evaluation: cut-offs, baselines and error metrics.

Inputs are long daily series ``(series, ds, y)``.  A series table holds one
row per (series, active day), so every window keyed by ``series`` sorts at
most the number of calendar days of that series (a few thousand rows for a
decade), whatever the size of the fact tables it was built from.  That is
what makes the per-series windows below safe at any data volume; many series
spread over all tasks.

Forecast frames are ``(series, cutoff, ds, y, yhat, yhat_lower, yhat_upper)``.

Baselines follow the source system: the seasonal naive value is the first
observation found at ``ds-7, ds-14, ds-21, ds-28`` among the days known at
the cut-off; the persistence value is the last observation at or before the
cut-off; the historical mean is the mean of everything up to the cut-off.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY, round_half_up
from ..functions.vocab import CV_HORIZON, CV_HORIZONS_KEPT, CV_INITIAL, CV_PERIOD, NAIVE_LAGS


def _factor(x: float) -> Column:
    """An exact decimal literal (money x factor stays exact)."""
    return F.lit(Decimal(str(round(x, 6))))


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ------------------------------------------------------------------ cut-offs

def cv_cutoffs(series: DataFrame, initial: int = CV_INITIAL, period: int = CV_PERIOD,
               horizon: int = CV_HORIZON) -> DataFrame:
    """Cut-off dates per series: ``max - horizon - k*period`` while ``>= min + initial``.

    One aggregate row per series, then a bounded ``sequence`` explode; no
    history row is replicated.
    """
    prof = series.groupBy("series").agg(F.min("ds").alias("_mn"), F.max("ds").alias("_mx"))
    room = F.datediff("_mx", "_mn") - horizon - initial
    k = F.explode(F.sequence(F.lit(0), F.floor(room / period).cast("int"))).alias("k")
    c = prof.filter(room >= 0).select("series", "_mx", k)
    return c.select("series", F.date_sub("_mx", F.lit(horizon) + F.col("k") * period).alias("cutoff"))


def cv_targets(series: DataFrame, cutoffs: DataFrame, horizon: int = CV_HORIZON) -> DataFrame:
    """Observed days in ``(cutoff, cutoff + horizon]`` for every cut-off.

    Dates are generated from the cut-off (``sequence``) and equi-joined to the
    history on ``(series, ds)``: no range join, no pair enumeration.
    """
    days = cutoffs.select(
        "series", "cutoff",
        F.explode(F.sequence(F.date_add("cutoff", 1), F.date_add("cutoff", horizon))).alias("ds"))
    return days.join(series.select("series", "ds", "y"), ["series", "ds"])


# -------------------------------------------------------------- as-of state

def history_at(series: DataFrame, points: DataFrame, at: str = "cutoff") -> DataFrame:
    """State of the history at each point: last value, running sum and count.

    ``points`` holds ``(series, <at>)``.  The points are interleaved with the
    history rows and one running window per series carries the state forward
    (an as-of join without a range join).  Returns ``(series, <at>, last_ds,
    last_y, sum_y, n_hist)`` with history rows ``ds <= <at>``.
    """
    h = series.select("series", F.col("ds").alias("_k"), F.lit(0).alias("_kind"),
                      F.col("ds").alias("_hds"), F.col("y").cast(MONEY).alias("_y"),
                      F.lit(None).cast("date").alias(at))
    p = points.select("series", F.col(at).alias("_k"), F.lit(1).alias("_kind"),
                      F.lit(None).cast("date").alias("_hds"), F.lit(None).cast(MONEY).alias("_y"),
                      F.col(at)).distinct()
    w = (Window.partitionBy("series").orderBy("_k", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = h.unionByName(p).select(
        "series", "_kind", at,
        F.last("_hds", ignorenulls=True).over(w).alias("last_ds"),
        F.last("_y", ignorenulls=True).over(w).alias("last_y"),
        F.sum("_y").over(w).cast(MONEY).alias("sum_y"),
        F.count("_y").over(w).alias("n_hist"))
    return u.filter(F.col("_kind") == 1).drop("_kind")


def persistence(series: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Last observation at or before each cut-off: ``(series, cutoff, persist_y)``."""
    s = history_at(series, cutoffs)
    return s.select("series", "cutoff", F.col("last_y").alias("persist_y"))


def mean_baseline(series: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Mean of all history up to each cut-off, in money (half-up to the cent)."""
    s = history_at(series, cutoffs)
    cents = (F.col("sum_y") * 100).cast("decimal(38,0)")
    n = F.col("n_hist").cast("decimal(38,0)")
    mean_cents = F.floor((cents * 2 + n) / (n * 2))
    return s.filter(F.col("n_hist") > 0).select(
        "series", "cutoff", "n_hist", (mean_cents.cast("decimal(38,0)") / 100).cast(MONEY).alias("mean_y"))


# ------------------------------------------------------------ seasonal naive

def seasonal_naive(series: DataFrame, targets: DataFrame, lags=NAIVE_LAGS,
                   bound: str = "cutoff") -> DataFrame:
    """First of ``y(ds - lag)`` over ``lags`` among days ``<= bound``.

    ``targets`` holds ``(series, <bound>, ds)``; one row per target with
    ``naive_y`` (NULL when no lag hits known history).  The lags are exploded
    and equi-joined on ``(series, day)``; ``min_by`` keeps the smallest lag.
    """
    t = targets.select("series", bound, "ds").distinct()
    probes = t.select("series", bound, "ds",
                      F.explode(F.array(*[F.lit(x) for x in lags])).alias("_lag"))
    probes = probes.withColumn("_src", F.date_sub("ds", F.col("_lag"))).filter(F.col("_src") <= F.col(bound))
    hist = series.select("series", F.col("ds").alias("_src"), F.col("y").cast(MONEY).alias("_y"))
    hits = (probes.join(hist, ["series", "_src"])
            .groupBy("series", bound, "ds").agg(F.min_by("_y", "_lag").alias("naive_y")))
    return t.join(hits, ["series", bound, "ds"], "left")


# ---------------------------------------------------- stand-in forecasts

def persistence_forecasts(series: DataFrame, cutoffs: DataFrame, horizon: int = CV_HORIZON,
                          band: float = 0.10) -> DataFrame:
    """Flat forecast from each cut-off (last known value), bounds ``±band``.

    A forecast SQL can rebuild, used to check the metric jobs against DuckDB;
    the real per-series model goes through the same metric jobs.
    """
    t = cv_targets(series, cutoffs, horizon)
    p = persistence(series, cutoffs)
    f = t.join(p, ["series", "cutoff"])
    return f.select("series", "cutoff", "ds", F.col("y").cast(MONEY).alias("y"),
                    F.col("persist_y").alias("yhat"),
                    F.round(F.col("persist_y") * _factor(1 - band), 2).cast(MONEY).alias("yhat_lower"),
                    F.round(F.col("persist_y") * _factor(1 + band), 2).cast(MONEY).alias("yhat_upper"))


# ---------------------------------------------------------------- metrics

def with_baselines(series: DataFrame, fc: DataFrame) -> DataFrame:
    """Forecast rows + seasonal naive (persistence fallback) + historical mean."""
    cut = fc.select("series", "cutoff").distinct()
    nv = seasonal_naive(series, fc.select("series", "cutoff", "ds"))
    st = history_at(series, cut)
    cents = (F.col("sum_y") * 100).cast("decimal(38,0)")
    n = F.col("n_hist").cast("decimal(38,0)")
    mean_y = (F.floor((cents * 2 + n) / (n * 2)).cast("decimal(38,0)") / 100).cast(MONEY)
    st = st.select("series", "cutoff", F.col("last_y").alias("persist_y"), mean_y.alias("mean_y"))
    out = fc.join(nv, ["series", "cutoff", "ds"], "left").join(st, ["series", "cutoff"], "left")
    out = out.withColumn("fallback", F.col("naive_y").isNull())
    return out.withColumn("naive_y", F.coalesce("naive_y", "persist_y")).filter(F.col("naive_y").isNotNull())


def error_by_granularity(fc: DataFrame) -> DataFrame:
    """MAE and MAPE after summing ``y`` and ``yhat`` per (cut-off, day/week/month).

    The three grains are produced from one scan (explode of three period keys)
    and one aggregation; periods with zero actual revenue are left out of
    both metrics (MAPE is undefined there).
    """
    grains = F.array(
        F.struct(F.lit("D").alias("grain"), F.col("ds").alias("period")),
        F.struct(F.lit("W").alias("grain"), F.trunc("ds", "week").alias("period")),
        F.struct(F.lit("M").alias("grain"), F.trunc("ds", "month").alias("period")))
    e = fc.select("series", "cutoff", "y", "yhat", F.explode(grains).alias("g")).select(
        "series", "cutoff", "y", "yhat", "g.grain", "g.period")
    per = (e.groupBy("series", "grain", "cutoff", "period")
           .agg(F.sum("y").alias("y"), F.sum("yhat").alias("yhat"))
           .filter(F.col("y") > 0))
    ae = F.abs(F.col("y") - F.col("yhat"))
    g = per.groupBy("series", "grain").agg(
        F.count(F.lit(1)).alias("n_periods"), F.sum(ae).alias("_sae"),
        F.avg(_dbl(ae) / _dbl("y")).alias("_mape"))
    return g.select("series", F.col("grain").alias("granularity"), "n_periods",
                    F.bround(_dbl("_sae") / _dbl("n_periods"), 0).cast("bigint").alias("mae"),
                    round_half_up(F.col("_mape") * 100, 2).alias("mape_pct"))


def metrics_by_horizon(fc: DataFrame, rolling: float = 0.1, keep=CV_HORIZONS_KEPT) -> DataFrame:
    """MAE, MAPE and interval coverage by horizon, as a rolling window of rows.

    Per series, ``w = max(1, floor(rolling * n))`` rows.  The value at horizon
    ``t`` averages the ``w`` rows ending with horizon ``t`` going back in
    horizon; the oldest horizon group in the window enters at its mean, for
    the part that fits.  Rows are first reduced per (series, horizon)
    (at most ``horizon`` groups per series), then the window start is found
    with an as-of step over cumulative counts: no pair enumeration.
    MAPE is NULL for a series that has a zero actual.
    """
    h = F.datediff("ds", "cutoff")
    # money errors and hit counts are summed exactly; only the ratio is a double
    ae = F.abs(F.col("y").cast(MONEY) - F.col("yhat").cast(MONEY))
    ape = _dbl(ae) / F.abs(_dbl("y"))
    cov = ((F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))).cast("bigint")
    g = fc.groupBy("series", h.alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(ae).cast(MONEY).alias("x_mae"), F.sum(ape).alias("x_mape"),
        F.sum(cov).alias("x_cov"), F.max((F.col("y") == 0).cast("int")).alias("_zero"))
    ws = Window.partitionBy("series")
    wc = ws.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mets = ["x_mae", "x_mape", "x_cov"]
    g = g.select("series", "h", "n", *mets,
                 F.sum("n").over(wc).alias("C"), F.sum("x_mae").over(wc).cast(MONEY).alias("S_x_mae"),
                 F.sum("x_mape").over(wc).alias("S_x_mape"), F.sum("x_cov").over(wc).alias("S_x_cov"),
                 F.greatest(F.floor(F.sum("n").over(ws) * rolling).cast("bigint"), F.lit(1)).alias("w"),
                 F.max("_zero").over(ws).alias("_zero"))
    # as-of: for each horizon t, the group i with C(i-1) <= C(t) - w < C(i)
    steps = g.select("series", (F.col("C") - F.col("n")).alias("_k"), F.lit(0).alias("_kind"),
                     F.struct("C", "n", *["S_" + m for m in mets], *mets).alias("_i"),
                     F.lit(None).cast("int").alias("h"))
    probes = g.select("series", (F.col("C") - F.col("w")).alias("_k"), F.lit(1).alias("_kind"),
                      F.lit(None).alias("_i"), "h")
    probes = probes.withColumn("_i", F.col("_i").cast(steps.schema["_i"].dataType))
    wl = Window.partitionBy("series").orderBy("_k", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (steps.unionByName(probes)
             .select("series", "h", "_kind", "_k", F.last("_i", ignorenulls=True).over(wl).alias("_i"))
             .filter((F.col("_kind") == 1) & (F.col("_k") >= 0)))
    t = g.join(found.select("series", "h", F.col("_k").alias("R"), "_i"), ["series", "h"])

    def val(m):
        part = (F.col("_i.C") - F.col("R")).cast("double") * _dbl("_i." + m) / _dbl("_i.n")
        return (_dbl(F.col("S_" + m) - F.col("_i.S_" + m)) + part) / _dbl("w")

    out = t.filter(F.col("h").isin(list(keep))).select(
        "series", F.col("h").cast("int").alias("horizon_days"),
        F.bround(val("x_mae"), 0).cast("bigint").alias("mae"),
        F.when(F.col("_zero") == 0, round_half_up(val("x_mape") * 100, 2)).alias("mape_pct"),
        round_half_up(val("x_cov") * 100, 2).alias("coverage_pct"))
    return out


def relmae_table(with_base: DataFrame) -> DataFrame:
    """Model vs seasonal naive vs historical mean: MAE, MAPE, RelMAE per series.

    Long form (one row per model and forecast row) and one aggregation; the
    naive MAE of each series is read back with a window over the 3 rows of
    that series.  Rows with a zero actual count for MAE, not for MAPE.
    """
    models = F.array(
        F.struct(F.lit("model").alias("model"), F.col("yhat").cast(MONEY).alias("pred")),
        F.struct(F.lit("seasonal_naive").alias("model"), F.col("naive_y").alias("pred")),
        F.struct(F.lit("historical_mean").alias("model"), F.col("mean_y").alias("pred")))
    e = with_base.select("series", "y", F.explode(models).alias("m")).select("series", "y", "m.model", "m.pred")
    ae = F.abs(F.col("y") - F.col("pred"))
    a = e.groupBy("series", "model").agg(
        F.count(F.lit(1)).alias("n"), F.sum(ae).alias("_sae"),
        F.avg(F.when(F.col("y") != 0, _dbl(ae) / _dbl("y"))).alias("_mape"))
    mae = _dbl("_sae") / _dbl("n")
    w = Window.partitionBy("series")
    naive_mae = F.max(F.when(F.col("model") == "seasonal_naive", mae)).over(w)
    return a.select("series", "model", "n",
                    F.bround(mae, 0).cast("bigint").alias("mae"),
                    round_half_up(F.col("_mape") * 100, 2).alias("mape_pct"),
                    round_half_up(F.try_divide(mae, naive_mae), 4).alias("relmae"))
