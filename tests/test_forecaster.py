"""Forecaster: recovers a noiseless signal; published shape properties."""

import datetime as dt

import numpy as np

from sparkmart.operators import forecaster as FM
from sparkmart.operators import scoring as SC
from sparkmart.operators import serving as SV


def _signal(days):
    t = np.asarray(days, dtype=float)
    return 1000 + 0.5 * t + 80 * np.sin(2 * np.pi * t / 365.25) + 40 * np.cos(2 * np.pi * t / 7)


def test_numpy_fit_recovers_noiseless_signal():
    days = np.arange(18000, 18000 + 1095)
    m = FM.fit(days, _signal(days))
    fut = np.arange(days[-1] + 1, days[-1] + 181)
    yhat, lo, hi = FM.predict(m, fut)
    assert np.max(np.abs(yhat - _signal(fut))) / 1000 < 0.01
    assert np.all(hi >= lo)


def test_fit_needs_two_rows():
    assert FM.fit(np.array([1]), np.array([1.0])) is None


def _series_df(spark, y, start=dt.date(2020, 1, 1), name="s"):
    rows = [(name, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series string, ds date, y double")


def test_forecast_180_future_rows_bounds_ordered(spark):
    days = np.arange(0, 400)
    s = _series_df(spark, _signal(days))
    out = SV.publish(FM.forecast_series(s, 180)).toPandas()
    assert len(out) == 180
    assert out.ds.min() > dt.date(2020, 1, 1) + dt.timedelta(days=399)
    assert (out.yhat_upper >= out.yhat_lower).all()


def test_published_forecast_non_negative_on_falling_series(spark):
    y = np.linspace(500, 5, 200)
    out = SV.publish(FM.forecast_series(_series_df(spark, y), 180)).toPandas()
    assert (out[["yhat", "yhat_lower", "yhat_upper"]] >= 0).all().all()


def test_model_params_one_row_per_series(spark):
    s = _series_df(spark, _signal(np.arange(100)), name="a").unionByName(
        _series_df(spark, _signal(np.arange(50)), name="b"))
    p = {r.series: r for r in FM.model_params(s).collect()}
    assert sorted(p) == ["a", "b"] and p["a"].n_obs == 100 and len(p["b"].coefficients) > 2


def test_cv_history_rows_equal_join_definition(spark):
    from sparkmart.operators import evaluation as E
    s = _series_df(spark, _signal(np.arange(700)))
    got = FM.cv_history(s, 365, 30, 90).groupBy("cutoff").count().collect()
    cut = E.cv_cutoffs(s, 365, 30, 90).collect()
    exp = {c.cutoff: (c.cutoff - dt.date(2020, 1, 1)).days + 1 for c in cut}
    assert {r.cutoff: r["count"] for r in got} == exp


def _noisy(n, seed=0, slope=0.4):
    rng = np.random.default_rng(seed)
    t = np.arange(n, dtype=float)
    return np.maximum(1000 + slope * t + 150 * np.cos(2 * np.pi * t / 7) + rng.normal(0, 60, n), 1.0)


def _cv_as_money(spark, y):
    from pyspark.sql import functions as F
    s = _series_df(spark, y)
    fc = FM.cv_forecasts(s)
    cast = [F.col(c).cast("decimal(38,2)").alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")]
    return s.withColumn("y", F.col("y").cast("decimal(38,2)")), fc.select("series", "cutoff", "ds", "y", *cast)


def test_interval_coverage_is_near_80_percent(spark):
    _, fc = _cv_as_money(spark, _noisy(900))
    inside = fc.selectExpr("avg(cast(y between yhat_lower and yhat_upper as int)) c").first().c
    assert 0.7 < inside < 0.92


def test_model_beats_the_weekly_naive(spark):
    from sparkmart.operators import evaluation as E
    s, fc = _cv_as_money(spark, _noisy(900, seed=1))
    table = {r.model: r for r in E.relmae_table(E.with_baselines(s, fc)).collect()}
    assert table["model"].relmae < 1 and table["seasonal_naive"].relmae == 1


def test_rising_series_of_90_days(spark):
    out = SV.publish(FM.forecast_series(_series_df(spark, np.arange(1.0, 91.0)), 180)).toPandas().sort_values("ds")
    assert len(out) == 180 and out.ds.min() == dt.date(2020, 1, 1) + dt.timedelta(days=90)
    assert (out.yhat_upper >= out.yhat).all() and (out.yhat >= out.yhat_lower).all()
    assert out.yhat.iloc[:30].mean() > 80  # goes on from where it rose to


def test_all_variants_of_a_group_equal_single_fits(spark):
    s = _series_df(spark, _noisy(560))
    key = ["variant", "cutoff", "ds"]
    together = FM.cv_forecasts(s, horizon=30, variants=FM.VARIANTS).toPandas().sort_values(key).reset_index(drop=True)
    for v in FM.VARIANTS[:2]:
        alone = FM.cv_forecasts(s, horizon=30, variants=[v]).toPandas().sort_values(key).reset_index(drop=True)
        assert together[together.variant == v[0]].reset_index(drop=True).yhat.equals(alone.yhat)


def test_stored_parameters_score_as_the_fit_predicts(spark, tmp_path):
    s = (_series_df(spark, _noisy(800), name="long").unionByName(_series_df(spark, _noisy(200, seed=3), name="under a year"))
         .unionByName(_series_df(spark, [5.0, 7.0], name="two days")).unionByName(_series_df(spark, [5.0], name="one day")))
    FM.model_params(s).write.parquet(str(tmp_path / "p"))
    scored = SC.forecast(spark.read.parquet(str(tmp_path / "p")), 180)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    key = ["series", "ds"]
    got, want = (x.toPandas().sort_values(key).reset_index(drop=True) for x in (scored, FM.forecast_series(s, 180)))
    assert got[key].equals(want[key]) and len(got) == 3 * 180
    for c in ("yhat", "yhat_lower", "yhat_upper"):
        assert np.allclose(got[c], want[c], rtol=1e-9, atol=1e-9)


def test_variants_with_daily_terms_score_too(spark):
    m = FM.fit(np.arange(18000, 18500), _noisy(500), 0.05, True)
    row = ("v", m["n"], dt.date(1970, 1, 1) + dt.timedelta(days=18000), dt.date(1970, 1, 1) + dt.timedelta(days=18499), m["scale"], m["sigma"], m["lam"], True,
           [float(c) for c in m["cps"]], [float(b) for b in m["beta"]])
    params = spark.createDataFrame([row], "series string, n_obs long, first_ds date, last_ds date, y_scale double, sigma double, bend double, daily boolean, "
                                          "changepoints array<double>, coefficients array<double>")
    got = SC.forecast(params, 60).toPandas().sort_values("ds")
    for c, want in zip(("yhat", "yhat_lower", "yhat_upper"), FM.predict(m, np.arange(18500, 18560))):
        assert np.allclose(got[c], want, rtol=1e-9)


def test_calibrated_bounds_cover_80_percent_of_every_series(spark):
    from sparkmart.operators import evaluation as E
    s = _series_df(spark, _noisy(1500), name="a").unionByName(_series_df(spark, _noisy(1400, seed=5, slope=-0.3), name="b"))
    fc = FM.cv_forecasts(s, period=15).withColumn("yhat", SC.F.col("yhat").cast("decimal(38,2)"))
    fc = SC.with_widths(fc, SC.conformal_widths(fc), SC.F.datediff("ds", "cutoff"))
    rows = E.metrics_by_horizon(fc).collect()
    assert len(rows) == 6 and all(78 <= r.coverage_pct <= 82 for r in rows)
    # steps behind the last width go on with the square root
    widths = spark.createDataFrame([("a", 1, 3.0), ("a", 4, 6.0)], "series string, step int, half_width double")
    far = spark.createDataFrame([("a", 1, 10.0), ("a", 16, 10.0), ("z", 1, 10.0)], "series string, step int, yhat double")
    got = {(r.series, r.step): r.yhat_upper for r in SC.with_widths(far, widths, SC.F.col("step")).collect()}
    assert got == {("a", 1): 13.0, ("a", 16): 22.0, ("z", 1): None}
