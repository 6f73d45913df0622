"""What the order jobs leave on disk and exchange: shuffle files, codecs, stars, keys, parsed values."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

import __spark_entry__ as entry
from sparkmart.functions.dates import parse_date
from sparkmart.operators import clean as C
from sparkmart.operators.constraints import Rule, violations
from sparkmart.plans import mart_store as MS
from sparkmart.session import _CLEANUP, shared_dir, shuffles_removed
from sparkmart.sources import feeds
from sparkmart.sources import store as ST
from sparkmart.sources import versions as V
from sparkmart.sources.store import _names


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def _left(spark, before):
    for _ in range(40):  # files go in the background
        if not (left := _shuffle_files(spark) - before):
            return left
        time.sleep(0.25)
    return left


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_steps_leave_no_shuffle_files(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    kept = df.repartition(3, "k")  # in use for as long as the test runs, so garbage collection would keep its files
    root, was, before = shared_dir(spark), spark.conf.get(_CLEANUP, None), _shuffle_files(spark)
    ST.publish_all({"t": kept}, root, check=lambda staged, _: {"n": staged["t"].groupBy("k").count().count()})
    V.write_lot(kept, root, "lots", "k")
    assert _left(spark, before) == set() and spark.conf.get(_CLEANUP, None) == was
    assert ST.read_published(spark, root, "t").count() == 1000 and kept.count() == 1000
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            pass
        assert spark.conf.get(_CLEANUP) == "true"
    assert spark.conf.get(_CLEANUP, None) == was


def test_a_query_builds_the_star_it_reads(spark, sf_small):
    opened, MS.Store._open = MS.Store._open, {}
    try:
        store = MS.Store.of(spark, sf_small)
        got = {r.libelle for r in entry.queries()["dim_categories"](spark, sf_small).collect()}
        assert got == {r[0] for r in store.clean("purchases").select("libelle_categorie").where("libelle_categorie IS NOT NULL").distinct().collect()}
        assert _names(spark, f"{store.root}/stars") == ["achats"] and _names(spark, f"{store.root}/sources") == ["purchases"]
        m = ST.manifest(spark, f"{store.root}/stars/achats/mart")
        assert set(m["schemas"]) == set(MS.STARS["achats"]) and set(m["checks"]) == {r.name for r in MS.RULES if MS.STAR_OF[r.table] == "achats"}
        entry.queries()["dim_employees"](spark, sf_small).count()
        assert _names(spark, f"{store.root}/stars") == ["achats", "ventes"]
        stored = _names(spark, ST.folder(spark, f"{store.root}/stars/ventes/mart", "facture"))
        landed = _names(spark, store.landed("sales")[0])
        assert all(x.endswith(".zstd.parquet") for x in stored if x.startswith("part-")) and all(x.endswith(".csv.gz") for x in landed if x.startswith("part-"))
    finally:
        MS.Store._open = opened


def test_no_rule_goes_from_one_star_to_the_other():
    assert all(MS.STAR_OF[r.table] == MS.STAR_OF[r.parent] for r in MS.RULES if r.kind == "foreign")


def test_rules_about_keys_exchange_keys_alone(spark):
    t = {"a": spark.createDataFrame([("x", "n" * 9), ("x", "n"), (None, "n"), (None, None), ("y", "n")], "k string, text string"),
         "b": spark.createDataFrame([("x", 1), ("z", 2), ("z", 3), (None, 4), ("y", 5)], "k string, v long")}
    rules = [Rule("a", ("k",), "unique"), Rule("a", ("text",), "unique", any_case=True), Rule("a", ("text",), "length", limit=5), Rule("b", ("k",), "foreign", parent="a", key="k"),
             Rule("b", ("v",), "unique")]
    df = violations(t, rules)
    assert {r.rule: r.n for r in df.collect()} == {"a.k:unique": 2, "a.text:unique": 2, "a.text:length": 1, "b.k:foreign": 2, "b.v:unique": 0}
    assert "Join" not in _plan(df)


def test_lines_are_exchanged_with_their_part_before_their_order(spark, sf_small):
    for feed in (feeds.sales_feed, feeds.order_feed):
        joins = [x for x in _plan(feed(spark, sf_small)).split("\n") if "Join Inner" in x]
        assert "l_orderkey" in joins[0] and not any("l_" in x and "c_custkey" in x for x in joins)


def test_values_are_parsed_once_a_row(spark):
    raw = spark.createDataFrame([("1", "3/4/2020", "a", "b", "c", "2", "-7.5", "m")], "seq string, " + ", ".join(f"{c} string" for c in C.PURCHASE_COLS))
    df = C.clean_purchases(raw)
    assert _plan(df).count("d/M/yyyy") == 1
    assert df.first().asDict() == {"seq": "1", "date_achat": dt.date(2020, 4, 3), "nom_fournisseur": "a", "libelle_article": "b", "libelle_categorie": "c", "quantite": 2,
                                   "prix_achat_total": 8, "mode_paiement": "m"}


def test_a_format_is_tried_on_texts_with_its_separator(spark):
    texts = {"3/4/2020": "2020-04-03", "2020-4-3": "2020-04-03", "3-4-2020": "2020-04-03", " 03/04/2020 ": "2020-04-03", "3/4-2020": None, "2020/4/3": None, "Début Juin 2024": "2024-06-01",
             "juin-2024": None, "-": None, "/": None, "": None, "32/1/2020": None, "29/2/2021": None, "31-12-1999": "1999-12-31"}
    df = spark.createDataFrame([(k,) for k in texts] + [(None,)], "t string").select("t", parse_date("t").cast("string").alias("d"))
    assert {r.t: r.d for r in df.collect()} == texts | {None: None}
    assert "Contains" in _plan(df) or "contains" in _plan(df).lower()
