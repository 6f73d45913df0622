"""The constraint gate before publishing, and step counters of the cleaning jobs."""

import datetime
import os
import uuid

import pytest

from sparkmart.operators import clean as C
from sparkmart.operators.constraints import ConstraintViolation, Rule, enforce, violations
from sparkmart.operators.counters import Counters
from sparkmart.plans import mart_store as MS
from sparkmart.sources import feeds
from sparkmart.sources import store as ST

RULES = [Rule("facture", ("id_facture",), "not_null"), Rule("facture", ("statut",), "domain", values=("Payé", "Partiel")), Rule("client", ("nom",), "length", limit=5),
         Rule("client", ("nom",), "unique", any_case=True), Rule("facture", ("id_facture",), "unique"), Rule("facture", ("id_client",), "foreign", parent="client", key="id_client")]


def _tables(spark, facture, client):
    return {"facture": spark.createDataFrame(facture, "id_facture string, id_client string, statut string"),
            "client": spark.createDataFrame(client, "id_client string, nom string")}


GOOD = ([("f1", "c1", "Payé"), ("f2", None, None)], [("c1", "Acme"), ("c2", "Beta")])


def test_all_rules_in_one_job(spark):
    t = _tables(spark, [("f1", "c1", "Payé"), ("f1", "c9", "Autre"), (None, "c8", None)], [("c1", "Acme"), ("c2", "ACME"), ("c3", "too long"), ("c1", None)])
    assert {r.rule: r.n for r in violations(t, RULES).collect()} == {
        "facture.id_facture:not_null": 1, "facture.statut:domain": 1, "client.nom:length": 1, "client.nom:unique": 1, "facture.id_facture:unique": 1,
        "facture.id_client:foreign": 2}
    empty = {k: v.limit(0) for k, v in t.items()}
    assert {r.n for r in violations(empty, RULES).collect()} == {0}


def test_a_set_with_an_orphan_is_not_published(spark):
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"gate-{uuid.uuid4().hex[:8]}")
    gate = lambda staged, folder: enforce(staged, RULES, folder)
    first = ST.publish_all(_tables(spark, *GOOD), root, check=gate)
    bad = _tables(spark, [*GOOD[0], ("f3", "nobody", "Payé"), ("f4", "c1", "Payé")], [*GOOD[1], ("c3", "BETA")])
    with pytest.raises(ConstraintViolation) as e:
        ST.publish_all(bad, root, check=gate)
    assert ST.current_version(spark, root) == first and ST.read_published(spark, root, "facture").count() == 2
    assert e.value.counts == {"facture.id_client:foreign": 1, "client.nom:unique": 1}
    rows = [tuple(r) for r in spark.read.parquet(f"{e.value.quarantine}/facture").collect()]
    assert rows == [("f3", "nobody", "Payé", ["facture.id_client:foreign"])]
    assert sorted(r.id_client for r in spark.read.parquet(f"{e.value.quarantine}/client").collect()) == ["c2", "c3"]
    # a rule that is only reported does not refuse, and its count is in the manifest
    lax = lambda staged, folder: enforce(staged, RULES, folder, frozenset(e.value.counts))
    second = ST.publish_all(bad, root, check=lax)
    assert ST.current_version(spark, root) == second and ST.manifest(spark, root)["checks"]["facture.id_client:foreign"] == 1


def test_jobs_count_their_steps_while_they_run(spark, sf_small):
    raw = {"sales": feeds.sales_feed(spark, sf_small), "clients": feeds.clients_feed(spark, sf_small), "purchases": feeds.purchases_feed(spark, sf_small)}
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"counts-{uuid.uuid4().hex[:8]}")
    counters = {n: Counters() for n in raw}
    ST.publish_all(C.clean_all(raw, counters=counters), root, counters=lambda stored: C.job_counts(raw, counters, stored))
    seen = ST.manifest(spark, root)["counters"]
    for name, report in (("sales", C.sales_report), ("purchases", C.purchases_report), ("clients", C.clients_report)):
        assert seen[name] == report(raw[name]).first().asDict()
    # counters that ran too high (a stage that ran twice) give way to counting
    counters["sales"].value = lambda point, name="n": 10 ** 6
    stored = {n: ST.read_published(spark, root, n) for n in raw}
    assert C.job_counts(raw, counters, stored) == seen


def test_a_line_whose_total_cannot_be_computed_is_published_and_reported(spark):
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"mart-{uuid.uuid4().hex[:8]}")
    sales = spark.createDataFrame(
        [("1", "22/11/1999", "F1-1", "Acme", None, "Maintenance", "pump", "9", None, "999", "Eva", "Payé"),
         ("2", "22/11/1999", "F1-2", "Acme", None, "Maintenance", "pump", "9", "111", "999", "Eva", "Payé")],
        "seq string, date string, facture_id string, client string, telephone string, service_type string, description string, "
        "quantite string, prix_unitaire string, total string, employe_en_charge string, statut_paiement string")
    purchases = spark.createDataFrame(
        [("1", "22/11/1999", "Paper Ltd", "paper", "A4", "3", "30", "Virement")],
        "seq string, date string, fournisseur string, article string, categorie string, quantite string, prix_achat_total string, mode_paiement string")
    clients = spark.createDataFrame(
        [("1", "Acme", "", "", "", "PN", None)],
        "seq string, nom_client string, entreprise string, telephone string, email string, ville string, notes string")
    ST.write_raw_archive({"sales": sales, "purchases": purchases, "clients": clients}, f"{root}/raw")
    MS.build_clean(spark, root)
    MS.build_mart(spark, root)
    lines = {r.id_facture: r.total_ligne for r in ST.read_published(spark, f"{root}/mart", "ligne_facture").collect()}
    assert lines == {"F1-1": None, "F1-2": 999}
    assert ST.manifest(spark, f"{root}/mart")["checks"]["ligne_facture.total_ligne:not_null"] == 1


def test_rows_that_break_a_rule_do_not_stop_the_queries(spark):
    from sparkmart.plans import QUERIES

    sf = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"tables-{uuid.uuid4().hex[:8]}")
    tables = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "Acme", 2, 1.0, "MACHINERY")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "Paper Ltd", 2, 1.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(1, None, "Brand#1", "LARGE", 1, 1.0), (2, "hot bolt", "Brand#2", None, 1, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "F", 1.0, datetime.datetime(1996, 1, 2), "5-LOW")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_shipdate timestamp", [(1, 1, 1, 1, 3.0, 30.0, 0.0, datetime.datetime(1996, 1, 3)), (1, 2, 1, 2, 3.0, None, 0.0, datetime.datetime(1996, 1, 3))]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    broken = {r.rule: r.n for r in QUERIES["gate_report"](spark, sf).collect() if r.n}
    assert broken == {"ligne_facture.description:not_null": 1, "ligne_facture.total_ligne:not_null": 1, "ligne_facture.id_service:not_null": 1,
                      "achat.prix_achat_total:not_null": 1}
    assert sorted(r.name for r in QUERIES["dim_keys"](spark, sf).collect()) == [
        "Acme", "Brand#2", "Eva Loemba", "Imprimerie", "Maintenance", "Paper Ltd", "Sérigraphie", "Vidéosurveillance"]
    with pytest.raises(ConstraintViolation):  # the batch job's gate still refuses the set
        MS.build_mart(spark, f"{sf}/job", MS.Store.of(spark, sf).clean)


def test_a_line_without_a_total_stops_no_query_that_reads_the_mart(spark):
    from sparkmart.plans import QUERIES

    sf = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"tables-{uuid.uuid4().hex[:8]}")
    day = datetime.datetime(1996, 1, 2)
    tables = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "Acme", 2, 1.0, "MACHINERY")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "Paper Ltd", 2, 1.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(67, "ring", "Brand#1", "LARGE", 1, 1.0), (2, "hot bolt", "Brand#2", "MEDIUM", 1, 1.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "F", 1.0, day, "5-LOW")]),
        # the first line's total is truly 999, and the feed leaves its price out
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_shipdate timestamp", [(1, 67, 1, 1, 9.0, 999.0, 0.0, day), (1, 2, 1, 2, 3.0, 30.0, 0.0, day)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    rows = {n: QUERIES[n](spark, sf).collect() for n in (
        "dim_suppliers dim_categories dq_duplicates dim_employees dq_lengths dq_domain dq_null_employee dq_zero_totals dq_orphans dq_orders_conserved "
        "dq_not_null fact_invoice dq_revenue_conserved fact_line merge_client_sources fact_purchase gate_report order_days order_employees "
        "order_clients").split()}
    assert {r.rule: r.n for r in rows["gate_report"] if r.n} == {"ligne_facture.total_ligne:not_null": 1}
    # the service's only line of that day has no total, so its day has none either
    assert {(r.table_name, r.column_name): r.n_null for r in rows["dq_not_null"] if r.n_null} == {("ligne_facture", "total_ligne"): 1, ("serie", "y"): 1}
    assert {r.id_facture: r.total_ligne for r in rows["fact_line"]} == {"F1-1": None, "F1-2": 30}
    assert rows["dq_orders_conserved"][0].conserved and rows["dq_revenue_conserved"][0].mart_total == 30
    assert {r.nom for r in rows["dim_suppliers"]} == {"Paper Ltd"} and {r.libelle for r in rows["dim_categories"]} == {"Brand#1", "Brand#2"}
    assert len(rows["fact_invoice"]) == len(rows["fact_purchase"]) == 2
    assert [r.nom_client for r in rows["merge_client_sources"]] == [r.nom_client for r in rows["order_clients"]] == ["Acme"]
    assert [r.nom_employe for r in rows["dim_employees"]] == [r.nom_employe for r in rows["order_employees"]] == ["Eva Loemba"]
    assert [(r.ds, r.y, r.n_orders) for r in rows["order_days"]] == [(day.date(), 1029, 2)]
