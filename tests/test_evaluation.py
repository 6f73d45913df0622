"""Evaluation operators: cut-offs, baselines, rolling metrics vs brute force."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd

from sparkmart.operators import evaluation as E


def _series(spark, days, start="2020-01-01", seed=0, name="s"):
    rng = np.random.default_rng(seed)
    d0 = dt.date.fromisoformat(start)
    rows = [(name, d0 + dt.timedelta(days=int(i)), Decimal(str(round(float(rng.uniform(1, 100)), 2))))
            for i in days]
    return spark.createDataFrame(rows, "series string, ds date, y decimal(38,2)")


def test_cutoffs_rule(spark):
    s = _series(spark, range(0, 600))
    got = sorted(r.cutoff for r in E.cv_cutoffs(s, initial=365, period=30, horizon=90).collect())
    last, first = dt.date(2020, 1, 1) + dt.timedelta(days=599), dt.date(2020, 1, 1)
    exp, c = [], last - dt.timedelta(days=90)
    while c >= first + dt.timedelta(days=365):
        exp.append(c)
        c -= dt.timedelta(days=30)
    assert got == sorted(exp)


def test_seasonal_naive_first_available_lag_within_cutoff(spark):
    days = [0, 7, 14]                      # 2020-01-01, -08, -15 present
    s = _series(spark, days)
    ys = {r.ds: r.y for r in s.collect()}
    t = spark.createDataFrame([("s", dt.date(2020, 1, 15), dt.date(2020, 1, 22)),
                               ("s", dt.date(2020, 1, 15), dt.date(2020, 1, 29)),
                               ("s", dt.date(2020, 1, 8), dt.date(2020, 1, 16))],
                              "series string, cutoff date, ds date")
    got = {(r.cutoff, r.ds): r.naive_y for r in E.seasonal_naive(s, t).collect()}
    assert got[(dt.date(2020, 1, 15), dt.date(2020, 1, 22))] == ys[dt.date(2020, 1, 15)]
    assert got[(dt.date(2020, 1, 15), dt.date(2020, 1, 29))] == ys[dt.date(2020, 1, 15)]
    assert got[(dt.date(2020, 1, 8), dt.date(2020, 1, 16))] is None


def test_history_at_matches_brute_force(spark):
    days = sorted(set(np.random.default_rng(3).integers(0, 200, 120).tolist()))
    s = _series(spark, days)
    cut = spark.createDataFrame([("s", dt.date(2020, 1, 1) + dt.timedelta(days=k)) for k in (0, 50, 51, 199)],
                                "series string, cutoff date")
    got = {r.cutoff: r for r in E.history_at(s, cut).collect()}
    pdf = s.toPandas()
    for c, r in got.items():
        h = pdf[pdf.ds <= c]
        assert r.n_hist == len(h)
        if len(h):
            assert r.last_y == h.sort_values("ds").y.iloc[-1]
            assert r.sum_y == sum(h.y)


def _rolling_mean_by_h(x, h, w):
    """Brute-force reference: mean of the w rows ending at horizon t (sorted by h)."""
    df = pd.DataFrame({"x": x, "h": h}).groupby("h").agg(s=("x", "sum"), n=("x", "count"))
    out = {}
    hs = list(df.index)
    for ti, t in enumerate(hs):
        need, tot, i = w, 0.0, ti
        while i >= 0 and need > 0:
            n, sm = df.n.iloc[i], df.s.iloc[i]
            take = min(n, need)
            tot += sm * take / n
            need -= take
            i -= 1
        if need == 0:
            out[t] = tot / w
    return out


def test_metrics_by_horizon_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in range(6):
        cutoff = dt.date(2021, 1, 1) + dt.timedelta(days=30 * c)
        for hh in sorted(set(rng.integers(1, 40, 25).tolist())):
            y = Decimal(str(round(float(rng.uniform(10, 50)), 2)))
            yh = Decimal(str(round(float(rng.uniform(10, 50)), 2)))
            rows.append(("s", cutoff, cutoff + dt.timedelta(days=hh), y, yh, yh - 5, yh + 5))
    fc = spark.createDataFrame(rows, "series string, cutoff date, ds date, y decimal(38,2), "
                                     "yhat decimal(38,2), yhat_lower decimal(38,2), yhat_upper decimal(38,2)")
    keep = list(range(1, 40))
    got = {r.horizon_days: r for r in E.metrics_by_horizon(fc, 0.1, keep).collect()}
    pdf = pd.DataFrame(rows, columns=["series", "cutoff", "ds", "y", "yhat", "lo", "hi"])
    h = [(d - c).days for d, c in zip(pdf.ds, pdf.cutoff)]
    ae = [abs(float(a) - float(b)) for a, b in zip(pdf.y, pdf.yhat)]
    cov = [float(lo <= y <= hi) for y, lo, hi in zip(pdf.y, pdf.lo, pdf.hi)]
    w = max(1, int(0.1 * len(pdf)))
    ref_mae, ref_cov = _rolling_mean_by_h(ae, h, w), _rolling_mean_by_h(cov, h, w)
    assert set(got) == set(ref_mae)
    for t, r in got.items():
        assert r.mae == round(ref_mae[t])
        assert abs(r.coverage_pct - 100 * ref_cov[t]) < 0.01


def test_error_by_granularity_monthly_sums_before_error(spark):
    rows = [("s", dt.date(2021, 1, 31), dt.date(2021, 2, 1) + dt.timedelta(days=i), Decimal("10"), Decimal("12"),
             Decimal("0"), Decimal("99")) for i in range(10)]
    fc = spark.createDataFrame(rows, "series string, cutoff date, ds date, y decimal(38,2), yhat decimal(38,2), "
                                     "yhat_lower decimal(38,2), yhat_upper decimal(38,2)")
    got = {r.granularity: r for r in E.error_by_granularity(fc).collect()}
    assert got["D"].n_periods == 10 and got["D"].mae == 2
    assert got["M"].n_periods == 1 and got["M"].mae == 20 and got["M"].mape_pct == 20.0
