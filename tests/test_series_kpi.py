"""Series, KPI and month-table operators on inline rows."""

import datetime as dt
from decimal import Decimal

from sparkmart.operators import kpi as K
from sparkmart.operators import series as S
from sparkmart.operators import serving as SV


def _d(s):
    return dt.date.fromisoformat(s)


def test_daily_series_counts_distinct_invoices_and_drops_lineless(spark):
    inv = spark.createDataFrame([("A", "2024-01-01"), ("B", "2024-01-01"), ("C", "2024-01-02")],
                                "id string, d string")
    lines = spark.createDataFrame([("A", 10.5, "x"), ("A", 2.0, "y"), ("B", 1.0, "x")],
                                  "id string, amt double, svc string")
    g = S.daily_series(inv, lines, inv_key="id", inv_date="d", line_key="id", amount="amt").collect()
    assert [(r.ds, r.y, r.n_orders) for r in g] == [(_d("2024-01-01"), Decimal("13.50"), 2)]
    s = S.daily_series(inv, lines, inv_key="id", inv_date="d", line_key="id", amount="amt", by="svc")
    got = sorted((r.svc, r.y, r.n_orders) for r in s.collect())
    assert got == [("x", Decimal("11.50"), 2), ("y", Decimal("2.00"), 1)]


def test_kpi_totals_round_half_away_from_zero(spark):
    daily = spark.createDataFrame([(_d("2024-01-01"), Decimal("1.50"), 1), (_d("2024-01-02"), Decimal("2.00"), 2)],
                                  "ds date, y decimal(38,2), n_orders bigint")
    r = K.kpi_totals(daily).collect()[0]
    assert (r.ca_total, r.nb_commandes, r.ca_moyen_jour) == (4, 3, 2)


def test_kpi_summary_empty_input_gives_no_row(spark):
    empty = spark.createDataFrame([], "series string, ds date, y decimal(38,2), n_orders bigint")
    assert K.kpi_summary(empty).count() == 0


def test_top_service_tie_goes_to_first_name(spark):
    by = spark.createDataFrame([("b", _d("2024-01-01"), Decimal("5"), 1), ("a", _d("2024-01-01"), Decimal("5"), 1)],
                               "service string, ds date, y decimal(38,2), n_orders bigint")
    assert K.top_service(by).collect()[0].top_service == "a"


def _store(spark, n, yhat=100, half=30, start="2026-09-01"):
    d0 = _d(start)
    rows = [("s", d0 + dt.timedelta(days=i), yhat, yhat - half, yhat + half) for i in range(n)]
    return spark.createDataFrame(rows, "series string, ds date, yhat bigint, yhat_lower bigint, yhat_upper bigint")


def test_month_rollup_sum_and_sqrt_width(spark):
    r = SV.month_rollup(_store(spark, 30)).collect()
    assert len(r) == 1 and r[0].yhat == 3000
    half = (r[0].yhat_upper - r[0].yhat_lower) / 2
    assert abs(half - 30 * 30 ** 0.5) < 0.01 and half < 900 / 5
    assert abs((r[0].yhat_upper + r[0].yhat_lower) / 2 - 3000) < 0.01


def test_month_rollup_lower_clipped(spark):
    r = SV.month_rollup(_store(spark, 30, yhat=10, half=500)).collect()
    assert r[0].yhat_lower == 0.0


def test_month_rollup_partial_month_dropped_unless_all_partial(spark):
    r = SV.month_rollup(_store(spark, 40)).collect()
    assert [x.month for x in r] == [_d("2026-09-01")]
    r = SV.month_rollup(_store(spark, 10)).collect()
    assert len(r) == 1 and r[0].n_days == 10


def test_forecast_lookup_bounds_and_order(spark):
    import pytest
    st = _store(spark, 40)
    got = SV.forecast_lookup(st, "s", 5, "2026-09-10").collect()
    assert [x.ds for x in got] == [_d("2026-09-10") + dt.timedelta(days=i) for i in range(5)]
    for bad in (0, 181):
        with pytest.raises(ValueError):
            SV.forecast_lookup(st, "s", bad)


def test_history_month_filter_is_per_series(spark):
    rows = [("a", _d("2024-01-01") + dt.timedelta(days=i), Decimal("1"), 1) for i in range(25)]
    rows += [("b", _d("2024-01-01") + dt.timedelta(days=i), Decimal("1"), 1) for i in range(5)]
    s = spark.createDataFrame(rows, "series string, ds date, y decimal(38,2), n_orders bigint")
    kept = S.keep_full_months(S.month_rollup(s)).collect()
    assert sorted((r.series, r.n_days) for r in kept) == [("a", 25), ("b", 5)]


def test_lines_of_a_large_table_are_dealt_over_tasks_by_its_size(spark, tmp_path):
    from sparkmart.plans import inputs
    from sparkmart.sources import tables

    n = 400_000
    spark.range(n).selectExpr("id o_orderkey", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 50)) o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20).selectExpr("id p_partkey", "concat('T', id % 3) p_type").write.parquet(f"{tmp_path}/part.parquet")
    (spark.range(3 * n).selectExpr("id % 400000 l_orderkey", "xxhash64(id) % 20 * -1 % 20 + 0 x", "cast(xxhash64(id) % 100000 as double) / 100 l_extendedprice", "uuid() pad")
     .selectExpr("l_orderkey", "abs(x) l_partkey", "l_extendedprice", "pad").write.parquet(f"{tmp_path}/lineitem.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "lineitem.parquet").glob("*.parquet"))
    tasks = tables.tasks_for(spark, f"{tmp_path}/lineitem.parquet")
    assert tasks and abs(tasks - size / tables.TASK_BYTES) <= 1.5
    for df in (inputs.by_service(spark, str(tmp_path)), inputs.series(spark, str(tmp_path))):
        assert f"hashpartitioning(l_orderkey#" in (plan := df._jdf.queryExecution().executedPlan().toString()) and f", {tasks}), REPARTITION_BY_NUM" in plan
    assert tables.tasks_for(spark, f"{tmp_path}/part.parquet") is None
    few = inputs.by_service(spark, str(tmp_path)).groupBy("service").sum("n_orders").count()
    assert few == 3
