"""Forecasts from stored parameters, as column expressions only.

A row of the parameter table (``forecaster.model_params``) holds what the fit found; trend,
Fourier terms and interval are evaluated by Spark on any days, so scoring needs no Python
worker and no history.  The formulas are those of ``forecaster.predict``, term by term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .forecaster import ORDERS, WEEK, YEAR, Z80

_TWO_PI = 6.283185307179586


def _terms(first: Column, period: float, order: int, day: Column) -> Column:
    """Sum of one seasonality's sine and cosine terms; its coefficients begin at ``first``."""
    out = F.lit(0.0)
    for wave, shift in ((F.sin, 0), (F.cos, order)):
        for j in range(1, order + 1):
            beta = F.coalesce(F.get("coefficients", first + (shift + j - 1)), F.lit(0.0))
            out = out + beta * wave(F.lit(_TWO_PI) * day * F.lit(float(j)) / F.lit(period))
    return out


def score(params: DataFrame, days: DataFrame) -> DataFrame:
    """``days`` (series, ds, ...) with yhat, yhat_lower and yhat_upper; series without parameters have no rows."""
    own = [c for c in days.columns if c != "series"]
    j = days.join(params.drop(*own), "series")
    day = F.unix_date("ds").cast("double")
    first, last = F.unix_date("first_ds").cast("double"), F.unix_date("last_ds").cast("double")
    j = j.withColumn("_t", (day - first) / F.greatest(last - first, F.lit(1.0))).withColumn("_k", F.size("changepoints"))
    bends = F.zip_with("changepoints", F.slice("coefficients", F.lit(3), F.col("_k")), lambda c, d: d * F.greatest(F.col("_t") - c, F.lit(0.0)))
    trend = F.get("coefficients", F.lit(0)) + F.get("coefficients", F.lit(1)) * F.col("_t") + F.aggregate(bends, F.lit(0.0), lambda a, x: a + x)
    at = F.col("_k") + 2
    season = _terms(at, YEAR, ORDERS["yearly"], day)
    at = at + 2 * ORDERS["yearly"]
    season = season + _terms(at, WEEK, ORDERS["weekly"], day)
    at = at + 2 * ORDERS["weekly"]
    season = season + F.when(F.col("daily"), _terms(at, 1.0, ORDERS["daily"], day)).otherwise(0.0)
    past = F.greatest(F.col("_t") - 1.0, F.lit(0.0))
    var = F.col("sigma") * F.col("sigma") + 2.0 * F.col("bend") * F.col("bend") * F.col("_k") * F.pow(past, F.lit(3.0)) / 3.0
    j = j.withColumn("_y", trend + season).withColumn("_half", Z80 * F.sqrt(var))
    return j.select("series", *own, (F.col("_y") * F.col("y_scale")).alias("yhat"), ((F.col("_y") - F.col("_half")) * F.col("y_scale")).alias("yhat_lower"),
                    ((F.col("_y") + F.col("_half")) * F.col("y_scale")).alias("yhat_upper"))


def next_days(params: DataFrame, horizon: int) -> DataFrame:
    """(series, ds): ``horizon`` days after each series' history."""
    ahead = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))
    return params.select("series", F.explode(ahead).alias("ds"))


def forecast(params: DataFrame, horizon: int) -> DataFrame:
    """(series, ds, yhat, yhat_lower, yhat_upper) of the days after each history."""
    return score(params, next_days(params, horizon))


def with_widths(fc: DataFrame, widths: DataFrame, step: Column) -> DataFrame:
    """``fc`` with bounds yhat -/+ the half width of its step; steps behind the last width grow with their square root."""
    last = widths.groupBy("series").agg(F.max_by("half_width", "step").alias("_last"), F.max("step").alias("_end"))
    j = fc.withColumn("_step", step).join(last, "series", "left")
    j = j.join(widths.select("series", F.col("step").alias("_step"), "half_width"), ["series", "_step"], "left")
    far = F.col("_last").cast("double") * F.sqrt(F.col("_step") / F.col("_end"))
    half = F.coalesce(F.col("half_width").cast("double"), far).cast(fc.schema["yhat"].dataType)
    own = [c for c in fc.columns if c not in ("yhat_lower", "yhat_upper")]
    return j.select(*own, (F.col("yhat") - half).cast(fc.schema["yhat"].dataType).alias("yhat_lower"),
                    (F.col("yhat") + half).cast(fc.schema["yhat"].dataType).alias("yhat_upper"))


def conformal_widths(cv: DataFrame, share: float = 0.8) -> DataFrame:
    """(series, step, n, half_width): the residuals' quantile of rolling-origin forecasts, by days after the cut-off.

    A discrete quantile as an aggregate: tasks count values, counts merge.
    """
    r = cv.select("series", F.datediff("ds", "cutoff").alias("step"), F.abs(F.col("y") - F.col("yhat")).alias("err"))
    return r.groupBy("series", "step").agg(F.count(F.lit(1)).alias("n"), F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY err)").alias("half_width"))
