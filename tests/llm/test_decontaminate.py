import re

import duckdb
import pytest

from sparkmart.llm import decontaminate
from sparkmart.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [(1, "b c d e f g h i j k l é"), (2, "one TWO"), (3, None), (4, ""), (5, "q q q q q q q q q q"), (None, "z"), (2, "one TWO"), (7, "É zero")]
DOCS = [(1, "A b c d e f g h i j k l É"), (1, "A b c d e f g h i j k l É"), (None, "x Y z"), (4, "q q q q q q q q q q q q q"),
        (5, "...one, two! three"), (60, "é ü É zero one two three four"), (61, "a b c d e f g h i")]


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    wins, out = {}, []
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add("null" if i is None else str(i))
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    ids |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), sorted(hit), sorted(ids)))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [decontaminate.BROADCAST_ROWS, 0])
def test_scan_against_brute_force(spark, make, odd, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)  # 0: the shuffled join
    bench = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, n int")
    got = sorted([(r.doc_id, r.n_words, r.hits, r["items"]) for r in decontaminate.scan(make(DOCS + odd), bench).collect()], key=str)
    assert got == brute(DOCS + odd, ITEMS)


def test_removal_and_empty_tables(spark, make, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make(DOCS + odd)
    clean = {str(x[:1]) + str(x[1]) for x in brute(DOCS + odd, ITEMS) if not x[2]}
    out = decontaminate.remove_documents(docs, bench)
    assert out.columns == docs.columns
    assert {str((r.doc_id,)) + str(len(words(r.text))) for r in out.collect()} <= clean
    assert out.count() == sum(not x[2] for x in brute(DOCS + odd, ITEMS))
    cut = {r._id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cut[0] == cut[1] == "A É" and cut[2] == "x Y" and cut[4] == "! three" and cut[6] == DOCS[6][1]
    none = make([])
    assert decontaminate.scan(none, bench).count() == 0
    assert decontaminate.scan(docs, bench.where("false")).where("size(hits) > 0").count() == 0


def test_query_against_sql_and_native(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES["op5_benchmark_decontamination"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(con.execute(decontaminate.ORACLE).fetchall()) and any(r[5] for r in got)


def test_shuffled_table_meets_probes_without_words(spark, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    seen = []
    real = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: seen.append((name, df)) or real(df, name))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.scan(make(DOCS), bench)
    plan = dict(seen)["met"]._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("SortMergeJoin [key" in x for x in plan)
    below = [plan[k + 1] for k, x in enumerate(plan) if "Exchange hashpartitioning(key" in x]
    assert len(below) == 2 and not any(re.search(r"\bw#", x) for x in below)
    assert sorted([(r.doc_id, r.n_words, r.hits, r["items"]) for r in out.collect()], key=str) == brute(DOCS, ITEMS)
