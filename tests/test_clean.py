"""Cleaning jobs and dedup on inline rows."""

from sparkmart.operators import clean as C
from sparkmart.operators import dedup as DD

SALES_COLS = ["seq", "date", "facture_id", "client", "telephone", "service_type", "description",
              "quantite", "prix_unitaire", "total", "employe_en_charge", "statut_paiement"]


def _sales(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} {'bigint' if c == 'seq' else 'string'}"
                                                 for c in SALES_COLS))


def test_duplicate_invoice_keeps_first_in_file_order(spark):
    rows = [(2, "01/06/2024", "F1", "A", None, "Imprimerie", "d", "1", "100", "100", "E", "Payé"),
            (1, "02/06/2024", "F1", "B", None, "Imprimerie", "d", "1", "200", "200", "E", "Payé")]
    out = C.clean_sales(_sales(spark, rows)).collect()
    assert len(out) == 1 and out[0]["nom_client"] == "B"


def test_rows_without_date_or_client_dropped_before_dedup(spark):
    rows = [(1, "pas une date", "F1", "A", None, "Imprimerie", "d", "1", "100", "100", "E", "Payé"),
            (2, "01/06/2024", "F1", "B", None, "Imprimerie", "d", "1", "100", "100", "E", "Payé"),
            (3, "01/06/2024", "F2", None, None, "Imprimerie", "d", "1", "100", "100", "E", "Payé")]
    out = C.clean_sales(_sales(spark, rows)).collect()
    assert [r["nom_client"] for r in out] == ["B"]


def test_sentinel_totals_recomputed(spark):
    rows = [(i, "01/06/2024", f"F{i}", "A", None, "Imprimerie", "d", "3", "150", t, "E", "Payé")
            for i, t in enumerate(["0", "999", None, "nan", "450", "700"])]
    out = {r["facture_id"]: r for r in C.clean_sales(_sales(spark, rows)).collect()}
    assert [out[f"F{i}"]["total_ligne"] for i in range(6)] == [450, 450, 450, 450, 450, 700]
    assert [out[f"F{i}"]["recomputed"] for i in range(6)] == [True] * 4 + [False, False]


def test_labels_and_statuses_normalised(spark):
    rows = [(1, "2024-06-01", "F1", "A", None, " sérigrafe", "d", "1", "1", "1", "E", "paye")]
    r = C.clean_sales(_sales(spark, rows)).collect()[0]
    assert (r["service"], r["statut_paiement"]) == ("Sérigraphie", "Payé")


def test_purchases_negative_empty_and_incomplete(spark):
    cols = "seq bigint, " + ", ".join(f"{c} string" for c in C.PURCHASE_COLS)
    rows = [(1, "01/06/2024", "S", "a", "c", "1", "-500", "Espèces"),
            (2, None, None, None, None, None, None, None),
            (3, "01/06/2024", None, "a", "c", "1", "10", None),
            (4, "01/06/2024", " S ", "a", None, "2", "10.5", None)]
    out = {r["seq"]: r for r in C.clean_purchases(spark.createDataFrame(rows, cols)).collect()}
    assert sorted(out) == [1, 4]
    assert out[1]["prix_achat_total"] == 500 and out[4]["prix_achat_total"] == 10
    assert out[4]["nom_fournisseur"] == "S" and out[4]["libelle_categorie"] is None
    compat = {r["seq"]: r for r in C.clean_purchases(spark.createDataFrame(rows, cols), compat_nan=True).collect()}
    assert compat[4]["libelle_categorie"] == "nan"


def test_clients_case_insensitive_dedup_keeps_mixed_case(spark):
    cols = "seq bigint, nom_client string, entreprise string, telephone string, email string, ville string"
    rows = [(1, "ACME SARL", "", "1", "nan", "pointe noire"),
            (2, "Acme Sarl", "x", "2", "a@b", "PN"),
            (3, "  Beta", None, None, None, "Dolisie")]
    out = {r["nom_client"]: r for r in C.clean_clients(spark.createDataFrame(rows, cols)).collect()}
    assert sorted(out) == ["Acme Sarl", "Beta"]
    assert out["Acme Sarl"]["ville"] == "Pointe-Noire"


def test_keep_first_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, seq int")
    got = {(r["k"], r["seq"]) for r in DD.keep_first(df, ["k"], ["seq"]).collect()}
    assert got == {(None, 1), ("a", 3)}


def test_sales_report_counts(spark):
    rows = [(1, "01/06/2024", "F1", "A", None, "Imprimerie", "d", "1", "100", "0", None, "Payé"),
            (2, "01/06/2024", "F1", "A", None, "Imprimerie", "d", "1", "100", "100", "E", "Payé"),
            (3, "bad", "F2", "A", None, "Imprimerie", "d", "1", "100", "100", "E", "Payé")]
    r = C.sales_report(_sales(spark, rows)).collect()[0].asDict()
    assert r == {"n_input": 3, "n_dropped_missing": 1, "n_duplicates": 1, "n_rejected": 0, "n_recomputed": 1,
                 "n_kept": 1, "n_without_employee": 1}


def test_fractional_quantity_is_rejected_with_a_reason(spark):
    rows = [(i, "2024-06-01", f, "A", None, "Imprimerie", "d", q, "10", "20", "E", "Payé") for i, (f, q) in enumerate(
        [("F1", "2"), ("F2", "2.5"), ("F2", "3"), ("F3", "abc"), ("F4", "4.0")])]
    raw = _sales(spark, rows)
    assert sorted(r.facture_id for r in C.clean_sales(raw).collect()) == ["F1", "F3", "F4"]
    assert [(r.facture_id, r.quantite, r.reason) for r in C.sales_rejects(raw).collect()] == [("F2", "2.5", "quantite:not_whole")]
    rep = C.sales_report(raw).first()
    assert (rep.n_input, rep.n_duplicates, rep.n_rejected, rep.n_kept) == (5, 1, 1, 3)


def test_purchase_with_a_fractional_quantity_is_rejected_with_a_reason(spark):
    cols = "seq bigint, " + ", ".join(f"{c} string" for c in C.PURCHASE_COLS)
    rows = [(1, "01/06/2024", "S", "a", "c", "2", "10", None), (2, "01/06/2024", "S", "a", "c", "2.5", "-70", None),
            (3, "01/06/2024", "S", "a", "c", "abc", "10", None), (4, "01/06/2024", "S", "a", "c", "4.0", "10", None),
            (5, None, None, None, None, None, None, None), (6, "01/06/2024", None, "a", "c", "1.5", "10", None),
            (7, "bad", "S", "a", "c", "1.5", "10", None)]
    raw = spark.createDataFrame(rows, cols)
    assert sorted(r.seq for r in C.clean_purchases(raw).collect()) == [1, 3, 4]
    assert [(r.seq, r.quantite, r.prix_achat_total, r.reason) for r in C.purchases_rejects(raw).collect()] == [(2, "2.5", "-70", "quantite:not_whole")]
    rep = C.purchases_report(raw).first()
    assert (rep.n_input, rep.n_empty, rep.n_incomplete, rep.n_undated, rep.n_rejected, rep.n_kept) == (7, 1, 1, 1, 1, 3)


def test_a_query_builds_only_its_own_source(spark, sf_small):
    from sparkmart.plans.mart_store import Store
    from sparkmart.sources.store import _names

    Store.forget()
    try:
        store = Store.of(spark, sf_small)
        n = store.raw("purchases").count()
        assert n and _names(spark, f"{store.root}/sources") == ["purchases"] and _names(spark, store.root) == ["sources"]
        assert store.clean("clients").count() and _names(spark, f"{store.root}/sources") == ["clients", "purchases"]
        files = [x for x in _names(spark, store.landed("purchases")[0]) if x.startswith("part-")]
        assert files and all(x.endswith(".json.snappy") for x in files)
        assert store.counters("purchases").first().n_input == n  # one job's counters, from its own set
    finally:
        Store.forget()


def test_kept_clients_are_built_from_the_customers_alone(spark):
    import os
    import uuid

    from sparkmart.plans import QUERIES
    from sparkmart.plans.mart_store import Store
    from sparkmart.sources.store import _names

    sf = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"tables-{uuid.uuid4().hex[:8]}")
    rows = [(10, "Acme", 2, "MACHINERY"), (11, "Bolts", 2, None), (12, "acme", 2, "MACHINERY"), (13, "Bolts", 2, "MACHINERY"), (20, None, 2, "MACHINERY")]
    # no other table is there; the tenth customer comes again in capitals
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{sf}/customer.parquet")
    kept = QUERIES["merge_duplicate_clients_kept"](spark, sf).collect()
    assert sorted((r.nom_client, r.seq) for r in kept) == [("Acme", 20), ("Bolts", 22)]
    root = Store.of(spark, sf).root
    assert _names(spark, root) == ["sources"] and _names(spark, f"{root}/sources") == ["clients"]


def test_first_sales_are_dealt_by_invoice_before_they_are_sorted(spark):
    from sparkmart.operators import clean as C

    cols = "seq long, date string, facture_id string, client string, telephone string, service_type string, description string, quantite string, prix_unitaire string, total string, employe_en_charge string, statut_paiement string"
    raw = spark.createDataFrame([(2, "1/2/2024", "F1", "B", None, "x", "d", "1", "5", "5", None, None), (1, "1/2/2024", "F1", "A", None, "x", "d", "1", "5", "5", None, None),
                                 (4, "1/2/2024", None, "D", None, "x", "d", "1", "5", "5", None, None), (3, "1/2/2024", None, "C", None, "x", "d", "1", "5", "5", None, None)], cols)
    out = C.clean_sales(raw)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(plan) if "REPARTITION_BY_COL" in x)
    assert not any("WindowGroupLimit" in x or " Sort " in x for x in plan[at:])
    assert sorted((r.seq, r.nom_client) for r in out.collect()) == [(1, "A"), (3, "C")]
