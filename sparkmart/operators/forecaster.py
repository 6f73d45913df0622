"""Per-series additive forecaster, fitted inside Spark as a grouped map.

Model (the decomposable trend + seasonality model of Taylor & Letham,
"Forecasting at Scale", 2018), solved with numpy only:

* ``y`` scaled by ``max|y|``; time scaled to [0, 1] over the fitted history;
* piecewise-linear trend, ``K = min(25, floor(0.8 n) - 1)`` changepoints at
  evenly spaced rows of the first 80 % of history; slope changes get a
  Laplace prior of scale ``changepoint_prior_scale`` (solved by reweighted
  ridge steps), base slope and offset a Gaussian prior of scale 5;
* Fourier seasonality: yearly (365.25 d, order 10) and weekly (7 d, order 3),
  Gaussian prior of scale 10 (0.01 for the yearly terms when the history
  spans less than a year, where they would otherwise absorb the trend);
  optional daily terms (order 4), which are constant on daily data;
* 80 % interval: ``yhat ± 1.2816 * sqrt(sigma² + 2 λ² K h³ / 3)`` with
  ``λ = mean |δ|`` and ``h`` the scaled distance past the history: future
  changepoints as a Poisson process with Laplace slope changes, in closed
  form instead of by sampling (so no seed is needed).

Spark side: one ``applyInPandas`` call fits every (series[, cut-off,
variant]) group in parallel; a group holds one row per active day of one
series, so its size is bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType)

from ..functions.vocab import CV_HORIZON, CV_INITIAL, CV_PERIOD
from ..session import ship

Z80 = 1.2815515655446004
YEAR, WEEK = 365.25, 7.0
ORDERS = {"yearly": 10, "weekly": 3, "daily": 4}
DEFAULT = {"changepoint_prior_scale": 0.05, "daily": False}

# Variants of the source system's model comparisons (fixed values).
VARIANTS = [
    ("base", 0.05, False),
    ("daily_on", 0.05, True),
    ("cps_0.01", 0.01, False),
    ("cps_0.50", 0.50, False),
]
# What each variant stands for.
VARIANT_LABELS = {
    "cps_0.01": "too rigid: underfitting",
    "base": "moderate flexibility: best bias/variance balance",
    "cps_0.50": "too reactive: overfitting",
    "daily_on": "daily seasonality on (constant on daily data)",
}


# ------------------------------------------------------------------ numpy

def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    x = 2.0 * np.pi * days[:, None] * np.arange(1, order + 1)[None, :] / period
    return np.hstack([np.sin(x), np.cos(x)])


def _seasonal(days: np.ndarray, daily: bool) -> np.ndarray:
    cols = [_fourier(days, YEAR, ORDERS["yearly"]), _fourier(days, WEEK, ORDERS["weekly"])]
    if daily:
        cols.append(_fourier(days, 1.0, ORDERS["daily"]))
    return np.hstack(cols)


def _trend(t: np.ndarray, cps: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - cps[None, :], 0.0)])


def fit(ds: np.ndarray, y: np.ndarray, cps_scale: float = 0.05, daily: bool = False,
        iters: int = 10) -> dict | None:
    """Fit one series. ``ds``: days since epoch (int), ``y``: float. None if < 2 rows."""
    order = np.argsort(ds, kind="stable")
    ds, y = ds[order].astype(float), y[order].astype(float)
    n = len(y)
    if n < 2:
        return None
    t0, span = ds[0], max(ds[-1] - ds[0], 1.0)
    t = (ds - t0) / span
    scale = float(np.max(np.abs(y))) or 1.0
    ys = y / scale
    hist = int(np.floor(0.8 * n))
    k = max(0, min(25, hist - 1))
    cps = t[np.linspace(0, hist - 1, k + 1).round().astype(int)[1:]] if k > 0 else np.zeros(0)
    xt = _trend(t, cps)
    xs = _seasonal(ds, daily)
    x = np.hstack([xt, xs])
    n_year = 2 * ORDERS["yearly"]
    season_prior = np.full(xs.shape[1], 10.0)
    if span < 365:
        season_prior[:n_year] = 0.01
    base_prior = np.array([5.0, 5.0])
    delta = np.full(k, cps_scale)
    sigma2 = max(float(np.var(ys)), 1e-4)
    xtx, xty = x.T @ x, x.T @ ys
    beta = np.zeros(x.shape[1])
    for _ in range(iters):
        lam = np.concatenate([sigma2 / base_prior ** 2,
                              sigma2 / (cps_scale * np.maximum(np.abs(delta), 1e-6)),
                              sigma2 / season_prior ** 2])
        beta = np.linalg.solve(xtx + np.diag(lam), xty)
        delta = beta[2:2 + k]
        resid = ys - x @ beta
        sigma2 = max(float(np.mean(resid ** 2)), 1e-8)
    return {"t0": t0, "span": span, "scale": scale, "cps": cps, "beta": beta,
            "sigma": float(np.sqrt(sigma2)), "daily": daily, "n": n,
            "lam": float(np.mean(np.abs(delta))) if k else 0.0, "k": k}


def predict(model: dict, ds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forecast at ``ds`` (days since epoch): yhat, lower, upper (original scale)."""
    ds = ds.astype(float)
    t = (ds - model["t0"]) / model["span"]
    x = np.hstack([_trend(t, model["cps"]), _seasonal(ds, model["daily"])])
    yhat = x @ model["beta"]
    h = np.maximum(t - 1.0, 0.0)
    var = model["sigma"] ** 2 + 2.0 * model["lam"] ** 2 * model["k"] * h ** 3 / 3.0
    half = Z80 * np.sqrt(var)
    s = model["scale"]
    return yhat * s, (yhat - half) * s, (yhat + half) * s


# ------------------------------------------------------------------ Spark

_EPOCH = pd.Timestamp("1970-01-01")


def _days(col: pd.Series) -> np.ndarray:
    return ((pd.to_datetime(col) - _EPOCH) // pd.Timedelta(days=1)).to_numpy()


def forecast_schema(keys: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(k, t, True) for k, t in keys] + [
        StructField("ds", DateType()), StructField("yhat", DoubleType()),
        StructField("yhat_lower", DoubleType()), StructField("yhat_upper", DoubleType())])


def _fit_group(key_names: list[str], horizon: int, variants: list[tuple[str, float, bool]] | None):
    """Grouped-map body: rows ``(keys…, origin, ds, y)`` of one group, fitted once per variant."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = key_names + (["variant"] if variants else []) + ["ds", "yhat", "yhat_lower", "yhat_upper"]
        parts = []
        if not pdf.empty:
            ds, y = _days(pdf["ds"]), pdf["y"].astype(float).to_numpy()
            origin = int(_days(pdf["origin"].iloc[:1])[0])
            days = np.arange(origin + 1, origin + horizon + 1)
            when = (_EPOCH + pd.to_timedelta(days, unit="D")).date
            for name, cps, daily in variants or [(None, DEFAULT["changepoint_prior_scale"], DEFAULT["daily"])]:
                m = fit(ds, y, cps, daily)
                if m is None:
                    continue
                yhat, lo, hi = predict(m, days)
                out = pd.DataFrame({"ds": when, "yhat": yhat, "yhat_lower": lo, "yhat_upper": hi})
                for k in key_names:
                    out[k] = pdf[k].iloc[0]
                if variants:
                    out["variant"] = name
                parts.append(out[cols])
        return pd.concat(parts) if parts else pd.DataFrame(columns=cols)
    return run


def fit_forecast(rows: DataFrame, keys: list[str], horizon: int,
                 variants: list[tuple[str, float, bool]] | None = None) -> DataFrame:
    """Fit one model per ``keys`` group (and variant) and forecast ``horizon`` days after ``origin``.

    ``rows``: ``(keys…, origin, ds, y)``, history rows only; all variants of a group
    are fitted from the same rows.  The groups are hash-partitioned by their keys
    before the Python workers run, so many small series fill every core.
    """
    ship(rows.sparkSession)
    types = {f.name: f.dataType for f in rows.schema.fields}
    fields = [(k, types[k]) for k in keys] + ([("variant", StringType())] if variants else [])
    return rows.groupBy(*keys).applyInPandas(_fit_group(keys, horizon, variants), forecast_schema(fields))


def forecast_series(series: DataFrame, horizon: int = 180) -> DataFrame:
    """Fit every series on its whole history; ``horizon`` days after its last day."""
    last = series.groupBy("series").agg(F.max("ds").alias("origin"))
    rows = series.select("series", "ds", F.col("y").cast("double").alias("y")).join(last, "series")
    return fit_forecast(rows, ["series"], horizon)


def model_params(series: DataFrame) -> DataFrame:
    """Fitted parameters per series (the model table; no pickled objects); ``scoring`` predicts from them."""
    schema = StructType([
        StructField("series", StringType()), StructField("n_obs", LongType()),
        StructField("first_ds", DateType()), StructField("last_ds", DateType()),
        StructField("y_scale", DoubleType()), StructField("sigma", DoubleType()),
        StructField("bend", DoubleType()), StructField("daily", BooleanType()),
        StructField("changepoints", ArrayType(DoubleType())),
        StructField("coefficients", ArrayType(DoubleType()))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = fit(_days(pdf["ds"]), pdf["y"].astype(float).to_numpy())
        if m is None:
            return pd.DataFrame(columns=[f.name for f in schema.fields])
        d = pd.to_datetime(pdf["ds"])
        return pd.DataFrame([{
            "series": pdf["series"].iloc[0], "n_obs": m["n"], "first_ds": d.min().date(),
            "last_ds": d.max().date(), "y_scale": m["scale"], "sigma": m["sigma"], "bend": m["lam"], "daily": m["daily"],
            "changepoints": [float(c) for c in m["cps"]],
            "coefficients": [float(b) for b in m["beta"]]}])

    ship(series.sparkSession)
    s = series.select("series", "ds", F.col("y").cast("double").alias("y"))
    return s.groupBy("series").applyInPandas(run, schema)


def cv_history(series: DataFrame, initial: int = CV_INITIAL, period: int = CV_PERIOD,
               horizon: int = CV_HORIZON) -> DataFrame:
    """History rows replicated once per cut-off they precede: ``(series, cutoff, ds, y)``.

    Cut-offs are ``last - horizon - k*period`` (k = 0..K), so a day ``ds``
    belongs to the refits ``k <= (last - horizon - ds) / period``: each row
    explodes into exactly the refits that use it (no join of every day with
    every cut-off, no filter afterwards).
    """
    prof = series.groupBy("series").agg(F.min("ds").alias("_mn"), F.max("ds").alias("_mx"))
    room = F.datediff("_mx", "_mn") - horizon - initial
    prof = prof.filter(room >= 0).select("series", "_mx", F.floor(room / period).cast("int").alias("_K"))
    h = series.select("series", "ds", F.col("y").cast("double").alias("y")).join(prof, "series")
    k_max = F.least(F.col("_K"), F.floor((F.datediff("_mx", "ds") - horizon) / period).cast("int"))
    h = h.filter(k_max >= 0).select("series", "ds", "y", "_mx",
                                    F.explode(F.sequence(F.lit(0), k_max)).alias("_k"))
    return h.select("series", F.date_sub("_mx", F.lit(horizon) + F.col("_k") * period).alias("cutoff"),
                    "ds", "y")


def cv_forecasts(series: DataFrame, horizon: int = CV_HORIZON, initial: int = CV_INITIAL,
                 period: int = CV_PERIOD, variants: list[tuple[str, float, bool]] | None = None) -> DataFrame:
    """Expanding-window refit at every cut-off (and variant); forecasts joined to actuals.

    Groups are (series, cut-off): many independent fits, all variants from the same rows.
    """
    rows = (cv_history(series, initial, period, horizon)
            .select("series", "cutoff", F.col("cutoff").alias("origin"), "ds", "y"))
    fc = fit_forecast(rows, ["series", "cutoff"], horizon, variants or [VARIANTS[0]])
    actual = series.select("series", "ds", F.col("y").cast("decimal(38,2)").alias("y"))
    return fc.join(actual, ["series", "ds"]).select(
        "series", "variant", "cutoff", "ds", "y", "yhat", "yhat_lower", "yhat_upper")


def drift_forecasts(series: DataFrame, window: int) -> DataFrame:
    """Refit on the days before ``last - window``; forecast the ``window`` days after."""
    last = series.groupBy("series").agg(F.date_sub(F.max("ds"), window).alias("origin"))
    rows = (series.join(last, "series").filter(F.col("ds") <= F.col("origin"))
            .select("series", "origin", "ds", F.col("y").cast("double").alias("y")))
    return fit_forecast(rows, ["series"], window).select("series", "ds", "yhat")


def variant_compare(cv: DataFrame) -> DataFrame:
    """Mean MAE and MAPE over all horizons of the 30-day CV, per series and variant."""
    err = F.abs(F.col("y").cast("double") - F.col("yhat"))
    a = cv.groupBy("series", "variant").agg(
        F.count(F.lit(1)).alias("n"), F.avg(err).alias("mae"),
        F.avg(F.when(F.col("y") != 0, err / F.abs(F.col("y").cast("double")))).alias("mape"))
    label = F.create_map(*[x for k, v in VARIANT_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return a.select("series", "variant", label[F.col("variant")].alias("behaviour"), "n",
                    F.bround("mae", 0).cast("bigint").alias("mae"),
                    F.round(F.col("mape") * 100, 1).alias("mape_pct"))


__all__ = ["cv_forecasts", "cv_history", "drift_forecasts", "fit", "fit_forecast",
           "forecast_series", "model_params", "predict", "variant_compare"]
