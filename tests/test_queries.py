"""Registered queries: DuckDB agreement on the small tables, and invariants."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import rows_of

TABLES = "region nation customer supplier part orders lineitem events".split()
SAMPLE = ["daily_series", "kpi_summary", "clean_sales", "merge_client_sources", "fact_line",
          "dq_revenue_conserved", "metrics_by_horizon", "relmae", "forecast_month_rollup",
          "validate_orders", "upsert_client"]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_small, t + '.parquet')}')")
    return con


def test_every_query_has_a_builder_and_known_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 78


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_duckdb(spark, duck, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["ds", "y", "n_orders"] and df.count() > 0


def test_dq_invariants_hold(spark, sf_small):
    q = entry.queries()
    assert all(r.conserved for r in q["dq_revenue_conserved"](spark, sf_small).collect())
    assert all(r.conserved for r in q["dq_orders_conserved"](spark, sf_small).collect())
    # purchases without a category keep a NULL key (reported, not invented)
    assert all(r.n == 0 for r in q["dq_orphans"](spark, sf_small).collect()
               if r.check_name != "achat.id_categorie")
    assert all(r.n_dup_keys == 0 for r in q["dq_duplicates"](spark, sf_small).collect())


@pytest.mark.parametrize("name", ["daily_series_by_service", "dedup_clients", "clean_report", "clean_report_clients", "relmae_table", "validate_orders"])
def test_partition_count_invariance(spark, sf_small, name):
    fn = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, sf_small)
            res.append(rows_of(df.columns, [tuple(r) for r in df.collect()]))
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_second_run_of_the_job_gives_the_same_tables(spark, sf_small):
    """D-10: the job publishes twice; counts and contents of all tables agree, and the old version is retained."""
    from pyspark.sql import functions as F

    from sparkmart.plans import mart_store as MS
    from sparkmart.session import shared_dir
    from sparkmart.sources import store as ST

    root = shared_dir(spark, "rerun")

    def state():
        out = {}
        for group in ("raw", "clean", "mart", "mart_series", "series"):
            for name in ST.manifest(spark, f"{root}/{group}")["schemas"]:
                df = ST.read_published(spark, f"{root}/{group}", name).drop("charge_le", "rafraichi_le")
                out[group, name] = tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())
        return out

    MS.run_pipeline(spark, sf_small, root)
    first, version = state(), ST.current_version(spark, f"{root}/mart")
    MS.run_pipeline(spark, sf_small, root)
    assert state() == first and ST.current_version(spark, f"{root}/mart") != version
    assert ST.retain(spark, f"{root}/mart", keep=1) == [version]
    assert state() == first


def test_lines_are_exchanged_once_before_the_join(spark, sf_small):
    from sparkmart.plans import inputs

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = inputs.series(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    on_order = [x for x in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert sum("REPARTITION_BY_COL" in x for x in on_order) == 1 and len(on_order) == 2  # the lines, and the orders to join
