"""Series, KPI and month-table queries."""

from __future__ import annotations

from ..operators import kpi as K
from ..operators import series as S
from . import inputs as I
from .oracle_feeds import with_ctes
from .registry import query

_S = I.SERIES_CTES


def _sql(body):
    return with_ctes(body, ctes=_S)


@query("daily_series", I.DAILY_SQL)
def daily_series(spark, sf):
    return I.daily(spark, sf)


@query("daily_series_by_service", I.BY_SERVICE_SQL)
def daily_series_by_service(spark, sf):
    return I.by_service(spark, sf)


@query("series_read", _sql("SELECT series, ds, y, n_orders FROM series"))
def series_read(spark, sf):
    return I.series_table(spark, sf).orderBy("series", "ds")


@query("kpi_totals", _sql("""
SELECT (CAST(SUM(y) * 100 AS BIGINT) * 2 + 100) // 200 AS ca_total,
       CAST(SUM(n_orders) AS BIGINT) AS nb_commandes,
       (CAST(SUM(y) * 100 AS BIGINT) * 2 + COUNT(*) * 100) // (COUNT(*) * 200) AS ca_moyen_jour
FROM daily HAVING COUNT(*) > 0"""))
def kpi_totals(spark, sf):
    return K.kpi_totals(I.stored_daily(spark, sf))


@query("kpi_top_service", _sql("""
SELECT service AS top_service, CAST(SUM(y) AS DECIMAL(38,2)) AS top_y
FROM by_service GROUP BY service ORDER BY SUM(y) DESC, service LIMIT 1"""))
def kpi_top_service(spark, sf):
    return K.top_service(I.stored_by_service(spark, sf))


@query("kpi_summary", _sql("""
SELECT (CAST(SUM(y) * 100 AS BIGINT) * 2 + 100) // 200 AS ca_total,
       CAST(SUM(n_orders) AS BIGINT) AS nb_commandes,
       (CAST(SUM(y) * 100 AS BIGINT) * 2 + COUNT(*) * 100) // (COUNT(*) * 200) AS ca_moyen_jour,
       COALESCE((SELECT service FROM by_service GROUP BY service
                 ORDER BY SUM(y) DESC, service LIMIT 1), 'N/A') AS top_service
FROM daily HAVING COUNT(*) > 0"""))
def kpi_summary(spark, sf):
    return K.kpi_summary(I.series_table(spark, sf))


@query("kpi_delta", _sql("""
SELECT CAST(SUM(CASE WHEN rn <= 30 THEN y END) AS DECIMAL(38,2)) AS last_y,
       CAST(SUM(CASE WHEN rn > 30 THEN y END) AS DECIMAL(38,2)) AS prev_y,
       round(CAST(SUM(CASE WHEN rn <= 30 THEN y END) - SUM(CASE WHEN rn > 30 THEN y END) AS DOUBLE) * 100
             / CAST(SUM(CASE WHEN rn > 30 THEN y END) AS DOUBLE), 1) AS delta_pct
FROM (SELECT y, row_number() OVER (ORDER BY ds DESC) AS rn FROM daily) t WHERE rn <= 60"""))
def kpi_delta(spark, sf):
    return K.kpi_delta(I.stored_daily(spark, sf))


@query("revenue_by_month", _sql("""
SELECT CAST(date_trunc('month', ds) AS DATE) AS month, service, CAST(SUM(y) AS DECIMAL(38,2)) AS y,
       SUM(n_orders)::BIGINT AS n_orders
FROM by_service GROUP BY 1, 2"""))
def revenue_by_month(spark, sf):
    return K.revenue_by_month(I.stored_by_service(spark, sf))


@query("revenue_by_service", _sql("""
SELECT service, CAST(SUM(y) AS DECIMAL(38,2)) AS y, SUM(n_orders)::BIGINT AS n_orders
FROM by_service GROUP BY 1"""))
def revenue_by_service(spark, sf):
    return K.revenue_by_service(I.stored_by_service(spark, sf))


@query("revenue_share", _sql("""
SELECT service, y, round(CAST(y AS DOUBLE) * 100 / CAST(SUM(y) OVER () AS DOUBLE), 1) AS share_pct
FROM (SELECT service, CAST(SUM(y) AS DECIMAL(38,2)) AS y FROM by_service GROUP BY 1) t"""))
def revenue_share(spark, sf):
    return K.revenue_share(I.stored_by_service(spark, sf))


_TRAIL = """SELECT series, ds, y, n_orders FROM (
  SELECT *, max(ds) OVER (PARTITION BY series) AS mx FROM series) t
WHERE ds >= mx - INTERVAL 180 DAY"""

_ROLL = f"""SELECT series, CAST(date_trunc('month', ds) AS DATE) AS month, CAST(SUM(y) AS DECIMAL(38,2)) AS y,
  COUNT(*) AS n_days FROM ({_TRAIL}) h GROUP BY 1, 2"""


@query("trailing_history", _sql(_TRAIL))
def trailing_history(spark, sf):
    return S.trailing_history(I.series_table(spark, sf))


@query("month_rollup_min_days", _sql(f"""
SELECT series, month, y, n_days FROM (
  SELECT *, max(n_days) OVER (PARTITION BY series) AS mx FROM ({_ROLL}) r) t
WHERE n_days >= 20 OR mx < 20"""))
def month_rollup_min_days(spark, sf):
    return S.keep_full_months(S.month_rollup(S.trailing_history(I.series_table(spark, sf))))


@query("months_excluded", _sql(f"""
SELECT series, month, y, n_days FROM (
  SELECT *, max(n_days) OVER (PARTITION BY series) AS mx FROM ({_ROLL}) r) t
WHERE n_days < 20 AND mx >= 20"""))
def months_excluded(spark, sf):
    return S.excluded_months(S.month_rollup(S.trailing_history(I.series_table(spark, sf))))


@query("series_profile", _sql("""
SELECT series, min(ds) AS first_ds, max(ds) AS last_ds,
       CAST(date_diff('day', min(ds), max(ds)) AS BIGINT) AS span_days, COUNT(*) AS n_obs,
       round(COUNT(*) / CAST(greatest(date_diff('day', min(ds), max(ds)), 1) AS DOUBLE), 4) AS density
FROM series GROUP BY series"""))
def series_profile(spark, sf):
    return S.series_profile(I.series_table(spark, sf))
