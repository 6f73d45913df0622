"""Model jobs: stored parameters, forecasts scored from them, rolling-origin refits, drift, variants, metrics.

A fitted value has no SQL twin, so the jobs' own queries return all their values without
one; the tests in ``tests/test_forecaster.py`` hold them.  What SQL can say of a result
(which rows there are, their dates and actuals, counts, the relations that any forecast
must hold) is a ``..._checks`` query beside each job.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vocab import CV_HORIZON, DRIFT_WINDOW_DAYS
from ..operators import drift as DR
from ..operators import evaluation as E
from ..operators import forecaster as FM
from ..operators import scoring as SC
from ..operators import serving as SV
from ..operators.series import GLOBAL
from ..session import shared_dir
from ..sources import versions as V
from . import inputs as I
from .eval_queries import CUTOFFS, DRIFT_CTES, EVAL_CTES, SERVE_CTES, TARGETS
from .mart_store import Store
from .oracle_feeds import with_ctes
from .registry import query

_EVAL, _DRIFT, _SERVE = EVAL_CTES, I.SERIES_CTES + DRIFT_CTES, I.SERIES_CTES + SERVE_CTES
#: The variants' cross-validation has a horizon of 30 days.
_CV30 = I.SERIES_CTES + [("cutoffs", CUTOFFS.replace(f"{CV_HORIZON}", "30")), ("targets", TARGETS.replace(f"{CV_HORIZON}", "30"))]
_VARIANTS = ", ".join(f"('{v[0]}')" for v in FM.VARIANTS)


def _series(spark, sf):
    return I.series_table(spark, sf)


def _cv(spark, sf):
    return Store.of(spark, sf).cv()


def _published(spark, sf):
    """180 days per series from the stored parameters, clipped at zero, in whole units."""
    return SV.publish(SC.forecast(Store.of(spark, sf).models(), SV.PUBLISH_HORIZON))


def _money(fc):
    return fc.select("series", "cutoff", "ds", "y", *[F.col(c).cast("decimal(38,2)").alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


def _measures(spark, sf):
    s = _series(spark, sf)
    return DR.drift_measures(s, FM.drift_forecasts(s, DRIFT_WINDOW_DAYS))


@query("forecast")
def forecast_values(spark, sf):
    return _published(spark, sf)


@query("forecast_calibrated")
def forecast_calibrated(spark, sf):
    """The published forecast with half widths from the residuals of the rolling-origin refits."""
    params = Store.of(spark, sf).models()
    widths = SC.conformal_widths(_cv(spark, sf))
    fc = SC.forecast(params, SV.PUBLISH_HORIZON).join(params.select("series", "last_ds"), "series")
    return SV.publish(SC.with_widths(fc, widths, F.datediff("ds", "last_ds")))


@query("model_params")
def model_params_values(spark, sf):
    return Store.of(spark, sf).models()


@query("cv_forecasts")
def cv_forecasts_values(spark, sf):
    return _cv(spark, sf)


@query("drift_measures")
def drift_measures_values(spark, sf):
    """The drift monitor on the fitted model."""
    return _measures(spark, sf)


@query("model_drift_status")
def model_drift_status_values(spark, sf):
    return DR.drift_status(_measures(spark, sf))


@query("model_drift_run")
def model_drift_run(spark, sf):
    """The run's record: whether the overall series was evaluated, and the exit status."""
    return DR.run_record(DR.drift_status(_measures(spark, sf)))


@query("model_metrics_by_horizon")
def model_metrics_by_horizon_values(spark, sf):
    """Errors and interval coverage of the fitted model by horizon."""
    return E.metrics_by_horizon(_cv(spark, sf))


@query("model_calibrated_metrics")
def model_calibrated_metrics(spark, sf):
    """The same with the calibrated bounds."""
    fc = _cv(spark, sf)
    return E.metrics_by_horizon(SC.with_widths(fc, SC.conformal_widths(fc), F.datediff("ds", "cutoff")))


@query("model_error_by_granularity")
def model_error_by_granularity_values(spark, sf):
    """Errors of the fitted model by day, week and month."""
    return E.error_by_granularity(_money(_cv(spark, sf)))


@query("model_relmae_table")
def model_relmae_table_values(spark, sf):
    """The fitted model beside the baselines."""
    return E.relmae_table(E.with_baselines(_series(spark, sf), _money(_cv(spark, sf))))


@query("model_forecast_months")
def model_forecast_months_values(spark, sf):
    """The monthly forecast of the fitted model."""
    return SV.month_rollup(_published(spark, sf))


@query("variant_compare")
def variant_compare_values(spark, sf):
    return FM.variant_compare(FM.cv_forecasts(_series(spark, sf), horizon=30, variants=FM.VARIANTS))


def _ordered(lo="yhat_lower", mid="yhat", hi="yhat_upper"):
    return (F.col(lo) <= F.col(mid)) & (F.col(mid) <= F.col(hi))


@query("forecast_checks", with_ctes("SELECT series, ds, true AS non_negative, true AS ordered FROM grid", ctes=_SERVE))
def forecast_checks(spark, sf):
    """180 published days per series (clipped at zero, whole units)."""
    fc = _published(spark, sf)
    return fc.select("series", "ds", (F.least("yhat", "yhat_lower", "yhat_upper") >= 0).alias("non_negative"), _ordered().alias("ordered"))


@query("model_params_checks", with_ctes("""SELECT series, COUNT(*) AS n_obs, min(ds) AS first_ds, max(ds) AS last_ds,
  CAST(max(abs(y)) AS DOUBLE) AS y_scale, true AS fitted FROM series GROUP BY series""", ctes=I.SERIES_CTES))
def model_params_checks(spark, sf):
    p = Store.of(spark, sf).models()
    return p.select("series", "n_obs", "first_ds", "last_ds", "y_scale",
                    ((F.col("sigma") > 0) & (F.size("coefficients") > F.size("changepoints"))).alias("fitted"))


@query("cv_forecasts_checks", with_ctes("SELECT series, cutoff, ds, y, true AS ordered FROM targets", ctes=_EVAL))
def cv_forecasts_checks(spark, sf):
    return _cv(spark, sf).select("series", "cutoff", "ds", "y", _ordered().alias("ordered"))


@query("drift_measures_checks", with_ctes("""SELECT series, status, detail, n_obs, n_days, n_relmae, span_days, short_history, n_obs_total, density,
  status = 'measured' AS has_errors FROM measures""", ctes=_DRIFT))
def drift_measures_checks(spark, sf):
    """The drift monitor on the fitted model."""
    m = _measures(spark, sf)
    return m.select("series", "status", "detail", "n_obs", "n_days", "n_relmae", "span_days", "short_history", "n_obs_total", "density",
                    (F.col("mae").isNotNull() & F.col("mape_pct").isNotNull()).alias("has_errors"))


@query("model_drift_status_checks", with_ctes("""SELECT series, n_relmae, status = 'skipped' AS skipped, n_relmae < 10 AS few,
  true AS level_fits FROM measures""", ctes=_DRIFT))
def model_drift_status_checks(spark, sf):
    """The fitted model's drift levels, each held against its own ratio."""
    m = _measures(spark, sf)
    st = DR.drift_status(m).join(m.select("series", "relmae_raw"), "series")
    r, lv = F.col("relmae_raw"), F.col("level")
    fits = (F.when(lv == "error", (r >= 1) & (F.col("series") == GLOBAL)).when(lv == "warning", r >= 0.85).when(lv == "ok", r < 0.85)
            .otherwise(F.lit(True)))
    return st.select("series", "n_relmae", (lv == "skipped").alias("skipped"), (F.col("n_relmae") < 10).alias("few"), fits.alias("level_fits"))


@query("model_metrics_by_horizon_checks", with_ctes("""SELECT DISTINCT series, CAST(h AS INTEGER) AS horizon_days, true AS in_range FROM
  (SELECT series, date_diff('day', cutoff, ds) AS h FROM targets) t WHERE h IN (30, 60, 90)""", ctes=_EVAL))
def model_metrics_by_horizon_checks(spark, sf):
    """Errors and interval coverage of the fitted model by horizon."""
    m = E.metrics_by_horizon(_cv(spark, sf))
    return m.select("series", "horizon_days", ((F.col("mae") >= 0) & F.col("coverage_pct").between(0, 100)).alias("in_range"))


@query("model_error_by_granularity_checks", with_ctes("""SELECT series, granularity, COUNT(*) AS n_periods FROM (
  SELECT series, cutoff, granularity, period, SUM(y) AS y FROM (
    SELECT series, cutoff, y, 'D' AS granularity, ds AS period FROM targets
    UNION ALL SELECT series, cutoff, y, 'W', CAST(date_trunc('week', ds) AS DATE) FROM targets
    UNION ALL SELECT series, cutoff, y, 'M', CAST(date_trunc('month', ds) AS DATE) FROM targets) g GROUP BY 1, 2, 3, 4) p
  WHERE y > 0 GROUP BY 1, 2""", ctes=_EVAL))
def model_error_by_granularity_checks(spark, sf):
    """Errors of the fitted model by day, week and month."""
    return E.error_by_granularity(_money(_cv(spark, sf))).select("series", "granularity", "n_periods")


@query("model_relmae_table_checks", with_ctes("""SELECT series, model, COUNT(*) AS n, model = 'seasonal_naive' AS is_reference
  FROM with_base, (VALUES ('model'), ('seasonal_naive'), ('historical_mean')) v(model) GROUP BY 1, 2""", ctes=_EVAL))
def model_relmae_table_checks(spark, sf):
    """The fitted model beside the baselines; the reference's own ratio is 1."""
    t = E.relmae_table(E.with_baselines(_series(spark, sf), _money(_cv(spark, sf))))
    return t.select("series", "model", "n", ((F.col("model") == "seasonal_naive") & (F.col("relmae") == 1)).alias("is_reference"))


@query("model_forecast_months_checks", with_ctes("""SELECT series, month, n_days, true AS ordered FROM (
  SELECT *, max(n_days) OVER (PARTITION BY series) AS mx FROM (
    SELECT series, CAST(date_trunc('month', ds) AS DATE) AS month, COUNT(*) AS n_days FROM grid GROUP BY 1, 2) a) b
  WHERE n_days >= 20 OR mx < 20""", ctes=_SERVE))
def model_forecast_months_checks(spark, sf):
    """The monthly forecast of the fitted model."""
    m = SV.month_rollup(_published(spark, sf))
    return m.select("series", "month", "n_days", (F.col("yhat_lower") <= F.col("yhat_upper")).alias("ordered"))


@query("variant_compare_checks", with_ctes(f"""SELECT series, variant, COUNT(*) AS n, true AS in_range
  FROM targets, (VALUES {_VARIANTS}) v(variant) GROUP BY 1, 2""", ctes=_CV30))
def variant_compare_checks(spark, sf):
    v = FM.variant_compare(FM.cv_forecasts(_series(spark, sf), horizon=30, variants=FM.VARIANTS))
    return v.select("series", "variant", "n", (F.col("mae") >= 0).alias("in_range"))


@query("forecast_store_replace", with_ctes(f"""SELECT series, COUNT(*) AS n_days, min(ds) AS first_ds, max(ds) AS last_ds,
  CASE WHEN series = '{GLOBAL}' THEN CAST(SUM(yhat) AS BIGINT) END AS replaced_yhat, true AS stamped FROM store GROUP BY series""", ctes=_SERVE))
def forecast_store_replace(spark, sf):
    """Publish every series, then replace only the overall series, in one commit.

    A reader sees the old rows of a series or the new ones, never a part of either.
    """
    root = shared_dir(spark, "forecast_store")
    s = _series(spark, sf)
    stamp = lambda df: df.withColumn("genere_le", F.current_timestamp())
    V.replace_part(stamp(_published(spark, sf)), root, "previsions", "series")
    V.replace_part(stamp(SV.weekly_repeat_forecast(s.filter(F.col("series") == GLOBAL))), root, "previsions", "series")
    return V.read_current(spark, root, "previsions").groupBy("series").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.max(F.when(F.col("series") == GLOBAL, 1)).alias("_g"), F.sum("yhat").cast("bigint").alias("_y"),
        F.bool_and(F.col("genere_le").isNotNull()).alias("stamped")).select(
        "series", "n_days", "first_ds", "last_ds", F.when(F.col("_g") == 1, F.col("_y")).alias("replaced_yhat"), "stamped")
