"""Drift levels by the ratio itself; the ratio on days that have both forecasts."""

import datetime as dt
import os
import uuid

import pytest

from sparkmart.operators import drift as DR
from sparkmart.sources import versions as V


def _measures(spark, ratio):
    row = ("global", "measured", None, 20, 30, 1.0, 1.0, round(ratio, 4), ratio, 20, 900, False, 500, 0.9)
    cols = ("series string, status string, detail string, n_obs long, n_days int, mae double, mape_pct double, relmae double, "
            "relmae_raw double, n_relmae long, span_days long, short_history boolean, n_obs_total long, density double")
    return spark.createDataFrame([row], cols)


def test_level_uses_the_ratio_before_rounding(spark):
    r = DR.drift_status(_measures(spark, 0.99996)).first()
    assert r.relmae == 1.0 and r.level == "warning" and not r.run_failed
    r = DR.drift_status(_measures(spark, 1.0)).first()
    assert r.level == "error" and r.run_failed
    assert DR.drift_status(_measures(spark, 0.84999)).first().level == "ok"


def test_a_day_without_forecast_is_in_neither_mean(spark):
    start = dt.date(2024, 1, 1)
    # training days all 100; validation days 110, but the last one is 500
    rows = [("global", start + dt.timedelta(days=i), 100.0 if i < 170 else 110.0) for i in range(200)]
    rows[189] = ("global", rows[189][1], 500.0)
    series = spark.createDataFrame(rows, "series string, ds date, y double")
    split = rows[-1][1] - dt.timedelta(days=30)
    fc = [("global", d, 105.0) for _, d, _ in rows if d > split and d != rows[189][1]]
    m = DR.drift_measures(series, spark.createDataFrame(fc, "series string, ds date, yhat double")).first()
    assert m.n_relmae == 27  # 28 days have a reference, one of them no forecast
    assert abs(m.relmae_raw - 0.5) < 1e-9  # 5 against 10 on every compared day


@pytest.mark.parametrize("overall, level, outcome, exit_status, n_notes", [
    ({"relmae_raw": 1.2}, "error", "drift", 1, 0), ({"relmae_raw": 0.5}, "ok", "no_drift", 0, 0), ({"relmae_raw": 0.9, "density": 0.3}, "warning", "no_drift", 0, 1),
    ({"relmae_raw": 1.2, "n_relmae": 4, "short_history": True}, "insufficient_points", "not_evaluated", 0, 2),
    ({"status": "skipped", "detail": "history too short"}, "skipped", "not_evaluated", 0, 1), (None, None, "not_evaluated", 0, 0)])
def test_run_record_tells_no_measure_from_no_drift(spark, overall, level, outcome, exit_status, n_notes):
    base = _measures(spark, 2.0)
    row = base.first().asDict()
    rows = [row | {"series": "service"}] + ([row | overall] if overall else [])
    measures = spark.createDataFrame(rows, base.schema)
    got = {r.series: r for r in DR.drift_status(measures).collect()}
    assert got["service"].level == "warning"
    if overall:
        assert got["global"].level == level and len(got["global"].notes) == n_notes
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"drift-{uuid.uuid4().hex[:8]}")
    assert DR.record_run(measures, root) == exit_status and DR.record_run(measures, root) == exit_status
    runs = V.read_current(spark, root, "executions").collect()
    assert [(r.outcome, r.failed, r.n_measured) for r in runs] == [(outcome, bool(exit_status), len(rows) - (level == "skipped"))] * 2
    assert V.read_current(spark, root, "mesures").count() == 2 * len(rows)
