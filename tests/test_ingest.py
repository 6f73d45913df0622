"""Order validation, upserts and the streaming job (replay gives the same tables)."""

import datetime as dt
import hashlib
import os
import random
import re
import uuid

import pytest

from sparkmart.operators import ingest as G
from sparkmart.operators.bloom import bloom, might_be_in
from sparkmart.sources import versions as V
from sparkmart.streaming import orders as ST

COLS = ("event_key string, seq bigint, client string, telephone string, date_facture date, service string, "
        "employe string, statut_paiement string, description string, quantite bigint, prix_unitaire bigint")
D = dt.date(2024, 6, 1)


def _orders(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_validation_collects_every_failed_rule(spark):
    rows = [("e1", 1, "", "1" * 21, D, "Jardinage", "E", "En attente", "d", 0, None),
            ("e2", 2, "A", "", D, "Imprimerie", "E", None, "d", 2, 150),
            ("e3", 3, "x" * 151, None, D, "Imprimerie", None, "Payé", "d" * 256, 1, 1)]
    got = {r.event_key: r for r in G.validate_orders(_orders(spark, rows)).collect()}
    assert got["e1"].reject_reasons == ("client:too_short,telephone:too_long,service:not_allowed,"
                                        "statut_paiement:not_allowed,quantite:below_min,prix_unitaire:missing")
    assert got["e2"].is_valid and got["e2"].total == 300 and got["e2"].statut == "Non payé"
    assert got["e3"].reject_reasons == "client:too_long,employe:missing,description:too_long"


def test_invoice_id_is_stable_per_event(spark):
    rows = [("e1", 1, "A", "", D, "Imprimerie", "E", "Payé", "d", 1, 1)]
    a, b = [G.accepted(_orders(spark, rows)).collect()[0] for _ in range(2)]
    assert a.facture_id == b.facture_id == hashlib.md5(b"e1").hexdigest()
    assert a.facture_no.startswith("FAC-2024-") and len(a.facture_no) == 17


def test_client_upsert_keeps_spelling_replaces_phone_only_when_given(spark):
    dim = spark.createDataFrame([("id1", "Acme", "111", "co")], "id_client string, nom_client string, "
                                                              "telephone string, entreprise string")
    rows = [("e1", 1, "ACME", "222", D, "Imprimerie", "E", "Payé", "d", 1, 1),
            ("e2", 2, "acme", "", D, "Imprimerie", "E", "Payé", "d", 1, 1),
            ("e3", 3, "New Co", "", D, "Imprimerie", "E", "Payé", "d", 1, 1),
            ("e4", 4, "NEW CO", "333", D, "Imprimerie", "E", "Payé", "d", 1, 1)]
    got = {r.nom_client: r for r in G.upsert_clients(dim, _orders(spark, rows)).collect()}
    assert sorted(got) == ["Acme", "New Co"]
    assert got["Acme"].telephone == "222" and got["Acme"].id_client == "id1" and got["Acme"].entreprise == "co"
    assert got["New Co"].telephone == "333"


def test_employee_upsert_inserts_unknown_only(spark):
    dim = spark.createDataFrame([("k", "Alice")], "id_employe string, nom_employe string")
    rows = [("e1", 1, "A", "", D, "Imprimerie", "ALICE", "Payé", "d", 1, 1),
            ("e2", 2, "A", "", D, "Imprimerie", "Bob", "Payé", "d", 1, 1)]
    got = sorted(r.nom_employe for r in G.upsert_employees(dim, _orders(spark, rows)).collect())
    assert got == ["Alice", "Bob"]


def _stream(spark, feed, files=3):
    base = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"ingest-{uuid.uuid4().hex[:8]}")
    landing, root = f"{base}/landing", f"{base}/tables"
    feed.repartition(files).write.parquet(landing)
    svc = spark.createDataFrame([("s1", "Imprimerie")], "id_service string, libelle string")
    clients = spark.createDataFrame([("k", "C0", "1")], "id_client string, nom_client string, telephone string")
    emps = spark.createDataFrame([], "id_employe string, nom_employe string")
    ST.seed_dimensions(clients, emps, root)
    return landing, root, f"{base}/ckpt", svc


def _state(spark, root):
    return {t: sorted(map(str, ST.read_table(spark, root, t).collect())) for t in ("facture", "ligne_facture", "rejets", "client", "employe")}


def _rows(n=12):
    rows = [(f"e{i}", i, f"C{i % 3}", "", D + dt.timedelta(days=i % 2), "Imprimerie", "E", "Payé", "d", 1, 10 + i) for i in range(n)]
    rows.append(("bad", 99, "", "", D, "Imprimerie", "E", "Payé", "d", 1, 1))
    rows.append(("unknown", 98, "C1", "", D, "Sérigraphie", "E", "Payé", "d", 1, 1))
    return rows


def test_same_event_in_two_files_is_stored_once(spark):
    feed = _orders(spark, _rows() + _rows()[:5])
    landing, root, ckpt, svc = _stream(spark, feed, 6)
    ST.run_order_stream(spark, landing, root, ckpt, feed.schema, svc)
    state = _state(spark, root)
    assert len(state["facture"]) == len(state["ligne_facture"]) == 12
    assert sorted(r.event_key for r in ST.read_table(spark, root, "facture").collect()) == sorted(f"e{i}" for i in range(12))
    reasons = {r.event_key: r.reject_reasons for r in ST.read_table(spark, root, "rejets").collect()}
    assert reasons == {"bad": "client:too_short", "unknown": "service:unknown"}  # a service that the dimension lacks
    assert sorted(r.nom_client for r in ST.read_table(spark, root, "client").collect()) == ["C0", "C1", "C2"]
    days = {r.ds: (int(r.y), r.n_orders) for r in ST.read_days(spark, root).collect()}
    assert days == {D: (sum(10 + i for i in range(0, 12, 2)), 6), D + dt.timedelta(days=1): (sum(10 + i for i in range(1, 12, 2)), 6)}


def test_crash_between_writes_then_replay(spark, monkeypatch):
    feed = _orders(spark, _rows())
    _, root, _, svc = _stream(spark, feed)
    before = V.snapshot(spark, root)

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(V, "commit", crash)
    with pytest.raises(RuntimeError):
        ST.process_batch(feed, 0, root, svc)
    assert V.snapshot(spark, root) == before  # nothing of the batch is visible
    monkeypatch.undo()
    ST.process_batch(feed, 0, root, svc)
    first = _state(spark, root)
    assert len(first["facture"]) == 12
    ST.process_batch(feed, 0, root, svc)  # replayed after its commit
    assert _state(spark, root) == first
    ST.process_batch(feed, 1, root, svc)  # the same events once more, rejected ones too
    assert _state(spark, root) == first


def test_tables_do_not_depend_on_how_the_feed_is_cut(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(40):
        name = rnd.choice(["Acme", "ACME", "acme", "Beta", "beta", "C0", "c0"])
        rows.append((f"e{i}", 1000 - 7 * i if i % 3 else i, name, rnd.choice(["", None, str(200 + i)]), D + dt.timedelta(days=rnd.randrange(70)),
                     rnd.choice(["Imprimerie", "Sérigraphie"]), rnd.choice(["Eva", "EVA", "Bob", ""]), "Payé", "d", 1, 10 + i))
    seen = []
    for cut in ([rows], [rows[:5], rows[5:]], [rows[20:], rows[10:30], rows[:20]]):
        _, root, _, svc = _stream(spark, _orders(spark, rows[:1]))
        for n, part in enumerate(cut):
            ST.process_batch(_orders(spark, rnd.sample(part, len(part))), n, root, svc)
        ST.tidy(spark, root)
        days = sorted((r.ds, r.y, r.n_orders) for r in ST.read_days(spark, root).collect())
        seen.append((_state(spark, root), days))
    assert seen[0] == seen[1] == seen[2]
    clients = {r.nom_client.lower(): r for r in ST.read_table(spark, root, "client").collect()}
    for name, r in clients.items():
        events = sorted((x[1], x[2], x[3]) for x in rows if x[2].lower() == name and x[5] == "Imprimerie" and x[6])
        phones = [t for _, _, t in events if t]
        assert r.telephone == (phones[-1] if phones else "1" if name == "c0" else None)
        assert r.nom_client == ("C0" if name == "c0" else events[0][1])


def test_a_batch_reads_its_partitions_and_buckets_only(spark):
    rows = [(f"e{i}", i, f"C{i}", "", dt.date(2024, 1 + i % 12, 3), "Imprimerie", "E", "Payé", "d", 1, 10 + i) for i in range(120)]
    _, root, _, svc = _stream(spark, _orders(spark, rows[:1]))
    ST.process_batch(_orders(spark, rows), 0, root, svc)
    state = V.snapshot(spark, root)
    days = ST.day_revenue(spark, root, state, ["2024-03"])
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*periode#\d+ = 2024-03", plan)
    assert {f.split("periode=")[1][:7] for f in days.inputFiles()} == {"2024-03"}
    batch = _orders(spark, rows[:2] + [("new", 500, "C1", "", D, "Imprimerie", "E", "Payé", "d", 1, 1)])
    keyed = batch.select("event_key", ST._bucket("event_key", ST.LEDGER_BUCKETS).alias("bucket"))
    known = ST.delivered(spark, root, state, keyed)
    buckets = {str(r.bucket) for r in keyed.collect()}
    assert {f.split("bucket=")[1].split("/")[0] for f in known.inputFiles() if "registre" in f} <= buckets
    assert sorted(r.event_key for r in known.collect()) == ["e0", "e1"]


def test_many_batches_keep_parts_small(spark, monkeypatch):
    monkeypatch.setattr(ST, "MOST_LOTS", 2)
    rows = _rows(5)
    _, root, _, svc = _stream(spark, _orders(spark, rows[:1]))
    for n, row in enumerate(rows[:5]):
        ST.process_batch(_orders(spark, [row]), n, root, svc)
        ST.tidy(spark, root)
        assert all(len(f) <= 3 for t in V.snapshot(spark, root)["parts"].values() for f in t.values())
    assert ST.read_table(spark, root, "facture").count() == 5 and sum(r.n_orders for r in ST.read_days(spark, root).collect()) == 5


def test_bloom_filter_never_drops_a_key(spark):
    small, large = spark.range(0, 3000, 7).selectExpr("cast(id as string) k"), spark.range(20_000).selectExpr("cast(id as string) k")
    maps, bits = bloom(small, "k", 429)
    left = {int(r.k) for r in might_be_in(large, "k", maps, bits).collect()}
    assert set(range(0, 3000, 7)) <= left and len(left) < 1500
    maps, bits = bloom(small.limit(0), "k", 0)
    assert might_be_in(large, "k", maps, bits).count() == 0
