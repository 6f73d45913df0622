"""Evaluation, drift and forecast-serving queries (with their DuckDB twins).

The metric jobs are checked against SQL on forecasts SQL can rebuild: the
flat (persistence) forecast from each cut-off for the evaluation jobs, the
last training value for the drift jobs, and the last week repeated for the
forecast store.  The per-series model runs through the same jobs in
``model_queries`` (rows-only checks).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vocab import CV_HORIZON, CV_INITIAL, CV_PERIOD, DRIFT_WINDOW_DAYS
from ..operators import drift as DR
from ..operators import evaluation as E
from ..operators import scoring as SC
from ..operators import serving as SV
from . import inputs as I
from .oracle_feeds import with_ctes
from .registry import query

AS_OF = "2001-09-01"

# --------------------------------------------------------------- SQL parts


def rhu(x: str, d: int) -> str:
    """SQL twin of ``round_half_up``."""
    k = float(10 ** d)
    return f"(floor(({x}) * {k} + 0.5) / {k})"


CUTOFFS = f"""SELECT series, CAST(mx - CAST({CV_HORIZON} + k * {CV_PERIOD} AS INTEGER) AS DATE) AS cutoff
FROM (SELECT series, mx, unnest(range(0, (date_diff('day', mn, mx) - {CV_HORIZON} - {CV_INITIAL}) // {CV_PERIOD} + 1)) AS k
      FROM (SELECT series, min(ds) AS mn, max(ds) AS mx FROM series GROUP BY series) p
      WHERE date_diff('day', mn, mx) - {CV_HORIZON} - {CV_INITIAL} >= 0) c"""

TARGETS = f"""SELECT c.series, c.cutoff, s.ds, s.y FROM cutoffs c JOIN series s
  ON s.series = c.series AND s.ds > c.cutoff AND s.ds <= c.cutoff + {CV_HORIZON}"""

HIST_AT = """SELECT c.series, c.cutoff, arg_max(s.y, s.ds) AS persist_y, SUM(s.y) AS sum_y, COUNT(*) AS n_hist
FROM cutoffs c JOIN series s ON s.series = c.series AND s.ds <= c.cutoff GROUP BY 1, 2"""

_MEAN = ("CAST(CAST((CAST(sum_y * 100 AS HUGEINT) * 2 + n_hist) // (2 * n_hist) AS DOUBLE) / 100 "
         "AS DECIMAL(38,2))")

NAIVE_HITS = """SELECT t.series, t.cutoff, t.ds, arg_min(h.y, l.lag) AS naive_y
FROM (SELECT DISTINCT series, cutoff, ds FROM targets) t CROSS JOIN (VALUES (7), (14), (21), (28)) l(lag)
JOIN series h ON h.series = t.series AND h.ds = t.ds - l.lag AND h.ds <= t.cutoff
GROUP BY 1, 2, 3"""

FC = """SELECT t.series, t.cutoff, t.ds, t.y, p.persist_y AS yhat,
  CAST(round(p.persist_y * 0.9, 2) AS DECIMAL(38,2)) AS yhat_lower,
  CAST(round(p.persist_y * 1.1, 2) AS DECIMAL(38,2)) AS yhat_upper
FROM targets t JOIN hist_at p ON t.series = p.series AND t.cutoff = p.cutoff"""

WITH_BASE = f"""SELECT f.*, COALESCE(n.naive_y, p.persist_y) AS naive_y, {_MEAN} AS mean_y
FROM fc f LEFT JOIN naive_hits n ON f.series = n.series AND f.cutoff = n.cutoff AND f.ds = n.ds
LEFT JOIN hist_at p ON f.series = p.series AND f.cutoff = p.cutoff
WHERE COALESCE(n.naive_y, p.persist_y) IS NOT NULL"""

EVAL_CTES = I.SERIES_CTES + [("cutoffs", CUTOFFS), ("targets", TARGETS), ("hist_at", HIST_AT),
                             ("naive_hits", NAIVE_HITS), ("fc", FC), ("with_base", WITH_BASE)]


def _sql(body: str) -> str:
    return with_ctes(body, ctes=EVAL_CTES)


def _series(spark, sf):
    return I.series_table(spark, sf)


def _fc(spark, sf):
    s = _series(spark, sf)
    return E.persistence_forecasts(s, E.cv_cutoffs(s))


# ------------------------------------------------------------- evaluation


@query("cv_cutoffs", _sql("SELECT * FROM cutoffs"))
def cv_cutoffs(spark, sf):
    return E.cv_cutoffs(_series(spark, sf))


@query("seasonal_naive", _sql("""
SELECT t.series, t.cutoff, t.ds, n.naive_y FROM (SELECT DISTINCT series, cutoff, ds FROM targets) t
LEFT JOIN naive_hits n ON t.series = n.series AND t.cutoff = n.cutoff AND t.ds = n.ds"""))
def seasonal_naive(spark, sf):
    s = _series(spark, sf)
    t = E.cv_targets(s, E.cv_cutoffs(s))
    return E.seasonal_naive(s, t.select("series", "cutoff", "ds"))


@query("persistence_fallback", _sql("SELECT series, cutoff, persist_y FROM hist_at"))
def persistence_fallback(spark, sf):
    s = _series(spark, sf)
    return E.persistence(s, E.cv_cutoffs(s))


@query("mean_baseline", _sql(f"SELECT series, cutoff, n_hist, {_MEAN} AS mean_y FROM hist_at"))
def mean_baseline(spark, sf):
    s = _series(spark, sf)
    return E.mean_baseline(s, E.cv_cutoffs(s))


_GRAINS = """SELECT series, cutoff, y, yhat, 'D' AS grain, ds AS period FROM fc
UNION ALL SELECT series, cutoff, y, yhat, 'W', CAST(date_trunc('week', ds) AS DATE) FROM fc
UNION ALL SELECT series, cutoff, y, yhat, 'M', CAST(date_trunc('month', ds) AS DATE) FROM fc"""


@query("error_by_granularity", _sql(f"""
SELECT series, grain AS granularity, COUNT(*) AS n_periods,
  CAST(round_even(CAST(SUM(abs(y - yhat)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 0) AS BIGINT) AS mae,
  {rhu('avg(CAST(abs(y - yhat) AS DOUBLE) / CAST(y AS DOUBLE)) * 100', 2)} AS mape_pct
FROM (SELECT series, grain, cutoff, period, SUM(y) AS y, SUM(yhat) AS yhat
      FROM ({_GRAINS}) e GROUP BY 1, 2, 3, 4) p
WHERE y > 0 GROUP BY 1, 2"""))
def error_by_granularity(spark, sf):
    return E.error_by_granularity(_fc(spark, sf))


_HG = """SELECT series, date_diff('day', cutoff, ds) AS h, COUNT(*) AS n,
  CAST(SUM(abs(y - yhat)) AS DECIMAL(38,2)) AS x_mae,
  SUM(CAST(abs(y - yhat) AS DOUBLE) / abs(CAST(y AS DOUBLE))) AS x_mape,
  SUM(CASE WHEN y >= yhat_lower AND y <= yhat_upper THEN 1 ELSE 0 END) AS x_cov,
  MAX(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS zero
FROM fc GROUP BY 1, 2"""
_W = "PARTITION BY series ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_HC = f"""SELECT *, SUM(n) OVER ({_W}) AS C, CAST(SUM(x_mae) OVER ({_W}) AS DECIMAL(38,2)) AS S_mae,
  SUM(x_mape) OVER ({_W}) AS S_mape, SUM(x_cov) OVER ({_W}) AS S_cov,
  greatest(CAST(floor(CAST(SUM(n) OVER (PARTITION BY series) AS DOUBLE) * 0.1) AS BIGINT), 1) AS w,
  MAX(zero) OVER (PARTITION BY series) AS z
FROM ({_HG}) g"""


def _hval(s: str, x: str) -> str:
    part = f"(CAST(iC - R AS DOUBLE) * CAST({x} AS DOUBLE) / CAST(i_n AS DOUBLE))"
    return f"((CAST({s} AS DOUBLE) + {part}) / CAST(w AS DOUBLE))"


METRICS_BY_HORIZON = f"""
SELECT series, CAST(h AS INTEGER) AS horizon_days,
  CAST(round_even({_hval('S_mae - iS_mae', 'ix_mae')}, 0) AS BIGINT) AS mae,
  CASE WHEN z = 0 THEN {rhu(_hval('S_mape - iS_mape', 'ix_mape') + ' * 100', 2)} END AS mape_pct,
  {rhu(_hval('S_cov - iS_cov', 'ix_cov') + ' * 100', 2)} AS coverage_pct
FROM (
  SELECT t.series, t.h, t.S_mae, t.S_mape, t.S_cov, t.w, t.z, t.C - t.w AS R,
    arg_max(i.C, i.h) AS iC, arg_max(i.n, i.h) AS i_n,
    arg_max(i.S_mae, i.h) AS iS_mae, arg_max(i.S_mape, i.h) AS iS_mape, arg_max(i.S_cov, i.h) AS iS_cov,
    arg_max(i.x_mae, i.h) AS ix_mae, arg_max(i.x_mape, i.h) AS ix_mape, arg_max(i.x_cov, i.h) AS ix_cov
  FROM ({_HC}) t JOIN ({_HC}) i ON t.series = i.series AND i.C - i.n <= t.C - t.w
  WHERE t.C - t.w >= 0 AND t.h IN (30, 60, 90)
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) r"""


@query("metrics_by_horizon", _sql(METRICS_BY_HORIZON))
def metrics_by_horizon(spark, sf):
    return E.metrics_by_horizon(_fc(spark, sf))


WIDTHS = """SELECT series, date_diff('day', cutoff, ds) AS step, COUNT(*) AS n, quantile_disc(abs(y - yhat), 0.8) AS half_width
FROM {} GROUP BY 1, 2"""
CALIBRATED = """SELECT f.series, f.cutoff, f.ds, f.y, f.yhat, f.yhat - w.half_width AS yhat_lower, f.yhat + w.half_width AS yhat_upper
FROM fc0 f JOIN widths w ON f.series = w.series AND date_diff('day', f.cutoff, f.ds) = w.step"""
CALIBRATED_CTES = EVAL_CTES[:-2] + [("fc0", FC), ("widths", WIDTHS.format("fc0")), ("fc", CALIBRATED)]


@query("conformal_widths", _sql(f"""SELECT series, CAST(step AS INTEGER) AS step, n, CAST(half_width AS DOUBLE) AS half_width
FROM ({WIDTHS.format("fc")}) w"""))
def conformal_widths(spark, sf):
    """Half widths that 80 % of the rolling-origin residuals stay within, by series and step."""
    return SC.conformal_widths(_fc(spark, sf))


@query("calibrated_metrics_by_horizon", with_ctes(METRICS_BY_HORIZON, ctes=CALIBRATED_CTES))
def calibrated_metrics_by_horizon(spark, sf):
    """Errors and coverage with these half widths."""
    fc = _fc(spark, sf)
    return E.metrics_by_horizon(SC.with_widths(fc, SC.conformal_widths(fc), F.datediff("ds", "cutoff")))


@query("relmae_table", _sql(f"""
SELECT series, model, n,
  CAST(round_even(CAST(sae AS DOUBLE) / CAST(n AS DOUBLE), 0) AS BIGINT) AS mae,
  {rhu('mape * 100', 2)} AS mape_pct,
  {rhu('(CAST(sae AS DOUBLE) / CAST(n AS DOUBLE)) / naive_mae', 4)} AS relmae
FROM (SELECT *, max(CASE WHEN model = 'seasonal_naive' THEN CAST(sae AS DOUBLE) / CAST(n AS DOUBLE) END)
             OVER (PARTITION BY series) AS naive_mae
      FROM (SELECT series, model, COUNT(*) AS n, SUM(abs(y - pred)) AS sae,
                   avg(CASE WHEN y <> 0 THEN CAST(abs(y - pred) AS DOUBLE) / CAST(y AS DOUBLE) END) AS mape
            FROM (SELECT series, y, 'model' AS model, yhat AS pred FROM with_base
                  UNION ALL SELECT series, y, 'seasonal_naive', naive_y FROM with_base
                  UNION ALL SELECT series, y, 'historical_mean', mean_y FROM with_base) e
            GROUP BY 1, 2) a) b"""))
def relmae_table(spark, sf):
    s = _series(spark, sf)
    return E.relmae_table(E.with_baselines(s, E.persistence_forecasts(s, E.cv_cutoffs(s))))


# ------------------------------------------------------------------ drift

_WD = DRIFT_WINDOW_DAYS
PROF = f"""SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, COUNT(*) AS n_obs_total,
  CAST(max(ds) - {_WD} AS DATE) AS split_ds, date_diff('day', min(ds), max(ds)) AS span_days
FROM series GROUP BY series"""
SPLIT = f"""SELECT s.series, s.ds, s.y, CASE WHEN s.ds <= p.split_ds THEN 'train' ELSE 'validation' END AS split
FROM series s JOIN prof p ON s.series = p.series"""
VAL = """SELECT s.series, p.split_ds, s.ds, s.y FROM series s JOIN prof p ON s.series = p.series
WHERE s.ds > p.split_ds"""
VAL_FC = """SELECT v.series, v.ds, t.yhat FROM (SELECT series, ds FROM split WHERE split = 'validation') v
JOIN (SELECT series, arg_max(y, ds) AS yhat FROM split WHERE split = 'train' GROUP BY series) t
ON v.series = t.series"""
VAL_NAIVE = """SELECT v.series, v.ds, arg_min(h.y, l.lag) AS naive_y
FROM val v CROSS JOIN (VALUES (7), (14), (21), (28)) l(lag)
JOIN series h ON h.series = v.series AND h.ds = v.ds - l.lag AND h.ds <= v.split_ds GROUP BY 1, 2"""
_ERR = "abs(v.y - f.yhat)"
MEASURES = f"""SELECT p.series,
  CASE WHEN p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5 THEN 'skipped' ELSE 'measured' END AS status,
  CASE WHEN p.span_days < {3 * _WD} THEN 'history too short'
       WHEN COALESCE(a.n_obs, 0) < 5 THEN 'too few validation observations' END AS detail,
  COALESCE(a.n_obs, 0) AS n_obs, {_WD} AS n_days,
  CASE WHEN NOT (p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5) THEN {rhu('a.mae', 2)} END AS mae,
  CASE WHEN NOT (p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5) THEN {rhu('a.mape * 100', 2)} END AS mape_pct,
  CASE WHEN NOT (p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5) THEN
    (CASE WHEN a.n_relmae = 0 THEN NULL WHEN a.mae_n = 0 THEN 'inf'::DOUBLE
          ELSE {rhu('a.mae_m / a.mae_n', 4)} END) END AS relmae,
  CASE WHEN NOT (p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5) THEN
    (CASE WHEN a.n_relmae = 0 THEN NULL WHEN a.mae_n = 0 THEN 'inf'::DOUBLE ELSE a.mae_m / a.mae_n END) END AS relmae_raw,
  CASE WHEN NOT (p.span_days < {3 * _WD} OR COALESCE(a.n_obs, 0) < 5) THEN COALESCE(a.n_relmae, 0) END AS n_relmae,
  CAST(p.span_days AS BIGINT) AS span_days, p.span_days < 365 AS short_history, p.n_obs_total,
  {rhu('CAST(p.n_obs_total AS DOUBLE) / CAST(greatest(p.span_days, 1) AS DOUBLE)', 4)} AS density
FROM prof p LEFT JOIN (
  SELECT v.series, COUNT(*) AS n_obs,
    CAST(SUM({_ERR}) AS DOUBLE) / CAST(COUNT({_ERR}) AS DOUBLE) AS mae,
    avg(CASE WHEN v.y <> 0 THEN CAST({_ERR} AS DOUBLE) / CAST(abs(v.y) AS DOUBLE) END) AS mape,
    CAST(SUM(CASE WHEN n.naive_y IS NOT NULL THEN {_ERR} END) AS DOUBLE)
      / CAST(COUNT(CASE WHEN n.naive_y IS NOT NULL THEN {_ERR} END) AS DOUBLE) AS mae_m,
    CAST(SUM(abs(v.y - n.naive_y)) AS DOUBLE) / CAST(COUNT(n.naive_y) AS DOUBLE) AS mae_n,
    CAST(COUNT(n.naive_y) AS BIGINT) AS n_relmae
  FROM val v LEFT JOIN val_fc f ON v.series = f.series AND v.ds = f.ds
  LEFT JOIN val_naive n ON v.series = n.series AND v.ds = n.ds GROUP BY 1) a ON p.series = a.series"""
DRIFT_CTES = [("prof", PROF), ("split", SPLIT), ("val", VAL), ("val_fc", VAL_FC),
              ("val_naive", VAL_NAIVE), ("measures", MEASURES)]


def _dsql(body: str) -> str:
    return with_ctes(body, ctes=I.SERIES_CTES + DRIFT_CTES)


def _measures(spark, sf):
    s = _series(spark, sf)
    return DR.drift_measures(s, DR.persistence_at_split(s))


@query("drift_split", _dsql("SELECT * FROM split"))
def drift_split(spark, sf):
    return DR.drift_split(_series(spark, sf))


@query("relmae", _dsql("SELECT * EXCLUDE (relmae_raw) FROM measures"))
def relmae(spark, sf):
    return _measures(spark, sf).drop("relmae_raw")


STATUS = """SELECT series, relmae, n_relmae, level, list_filter([history, few], lambda x: x IS NOT NULL) AS notes,
  MAX(CASE WHEN level = 'error' THEN 1 ELSE 0 END) OVER () = 1 AS run_failed
FROM (SELECT *, CASE WHEN level = 'insufficient_points' THEN 'too few comparison points: threshold not applied' END AS few
FROM (SELECT series, relmae, n_relmae,
  CASE WHEN status = 'skipped' THEN 'skipped' WHEN n_relmae < 10 THEN 'insufficient_points'
       WHEN relmae_raw >= 1.0 AND series = 'global' THEN 'error' WHEN relmae_raw >= 0.85 THEN 'warning' ELSE 'ok' END AS level,
  CASE WHEN status = 'skipped' THEN detail
       WHEN short_history THEN 'short history: yearly seasonality not identifiable'
       WHEN density < 0.5 THEN 'sparse history: seasonality estimated on few points' END AS history
FROM measures) m) n"""


@query("drift_status", _dsql(STATUS))
def drift_status(spark, sf):
    return DR.drift_status(_measures(spark, sf))


@query("drift_run", _dsql(f"""
SELECT n_measured, n_skipped, n_too_few, n_warnings, overall_evaluated, failed,
  CASE WHEN failed THEN 'drift' WHEN overall_evaluated THEN 'no_drift' ELSE 'not_evaluated' END AS outcome, CAST(failed AS INTEGER) AS exit_status
FROM (SELECT COUNT(*) FILTER (WHERE level <> 'skipped') AS n_measured, COUNT(*) FILTER (WHERE level = 'skipped') AS n_skipped,
  COUNT(*) FILTER (WHERE level = 'insufficient_points') AS n_too_few, COUNT(*) FILTER (WHERE level = 'warning') AS n_warnings,
  COALESCE(bool_or(series = 'global' AND level IN ('error', 'warning', 'ok')), false) AS overall_evaluated,
  COALESCE(bool_or(level = 'error'), false) AS failed FROM ({STATUS}) s) r"""))
def drift_run(spark, sf):
    return DR.run_record(DR.drift_status(_measures(spark, sf)))


# ---------------------------------------------------------------- serving

GRID = """SELECT series, CAST(last_ds + CAST(step AS INTEGER) AS DATE) AS ds, CAST(step AS INTEGER) AS step
FROM (SELECT series, max(ds) AS last_ds, unnest(range(1, 181)) AS step FROM series GROUP BY series) g"""
STORE = """SELECT g.series, g.ds,
  CAST(round_even(greatest(CAST(v AS DOUBLE), 0.0), 0) AS BIGINT) AS yhat,
  CAST(round_even(greatest(CAST(v * 0.9 AS DOUBLE), 0.0), 0) AS BIGINT) AS yhat_lower,
  CAST(round_even(greatest(CAST(v * 1.1 AS DOUBLE), 0.0), 0) AS BIGINT) AS yhat_upper
FROM (SELECT g.series, g.ds, COALESCE(h.y, l.last_y) AS v FROM grid g
      LEFT JOIN series h ON h.series = g.series AND h.ds = CAST(g.ds - CAST(ceil(g.step / 7.0) * 7 AS INTEGER) AS DATE)
      JOIN (SELECT series, arg_max(y, ds) AS last_y FROM series GROUP BY series) l ON l.series = g.series) g"""
MROLL = f"""SELECT series, month, yhat,
  {rhu('greatest(CAST(yhat AS DOUBLE) - sqrt(CAST(n_days AS DOUBLE)) * half, 0.0)', 2)} AS yhat_lower,
  {rhu('CAST(yhat AS DOUBLE) + sqrt(CAST(n_days AS DOUBLE)) * half', 2)} AS yhat_upper, n_days
FROM (SELECT *, max(n_days) OVER (PARTITION BY series) AS mx FROM (
  SELECT series, CAST(date_trunc('month', ds) AS DATE) AS month, CAST(SUM(yhat) AS BIGINT) AS yhat,
    avg(CAST(yhat_upper - yhat_lower AS DOUBLE) / 2) AS half, COUNT(*) AS n_days
  FROM store GROUP BY 1, 2) a) b
WHERE n_days >= 20 OR mx < 20"""
SERVE_CTES = [("grid", GRID), ("store", STORE), ("mroll", MROLL)]


def _ssql(body: str) -> str:
    return with_ctes(body, ctes=I.SERIES_CTES + SERVE_CTES)


def _store(spark, sf):
    return SV.weekly_repeat_forecast(_series(spark, sf))


@query("future_grid", _ssql("SELECT * FROM grid"))
def future_grid(spark, sf):
    return SV.future_grid(_series(spark, sf))


@query("forecast_lookup", _ssql(f"""
SELECT ds, yhat, yhat_lower, yhat_upper FROM store
WHERE series = 'global' AND ds >= DATE '{AS_OF}' ORDER BY ds LIMIT 90"""))
def forecast_lookup(spark, sf):
    return SV.forecast_lookup(_store(spark, sf), "global", 90, AS_OF)


@query("forecast_month_rollup", _ssql("SELECT * FROM mroll"))
def forecast_month_rollup(spark, sf):
    return SV.month_rollup(_store(spark, sf))


@query("forecast_caption", _ssql("""
SELECT series, CAST(trunc(avg(CAST(yhat AS DOUBLE))) AS BIGINT) AS mean_month_yhat,
  CAST(trunc(max(yhat_upper)) AS BIGINT) AS max_month_upper, COUNT(*) AS n_months
FROM mroll GROUP BY series"""))
def forecast_caption(spark, sf):
    return SV.caption(SV.month_rollup(_store(spark, sf)))
