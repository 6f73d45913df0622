import duckdb
import numpy as np
import pytest

from sparkmart.llm import topk
from sparkmart.llm.queries import QUERIES


def brute(codes, queries, k):
    out = []
    for qi, q in queries:
        d = sorted((bin((q ^ c) & (2**64 - 1)).count("1"), i) for i, c in codes)
        out += [(qi, r, i, dist) for r, (dist, i) in enumerate(d[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 5, 300, 3000])
def test_nearest_covers_the_kth_distance(n):
    rng = np.random.default_rng(n)
    codes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    held = rng.integers(1, 4, len(codes))
    asked = np.concatenate([rng.integers(0, 2**64, 30, dtype=np.uint64), codes[:10]])
    who, entry, dist = topk.nearest(topk.SegmentIndex(codes), held, asked, 10)
    for i, q in enumerate(asked):
        full = np.array([bin(int(q) ^ int(c)).count("1") for c in codes], int)
        order = np.argsort(full, kind="stable")
        total = np.cumsum(held[order])
        limit = full[order][np.searchsorted(total, 10)] if n and total[-1] >= 10 else 64
        assert set(entry[who == i]) == set(np.flatnonzero(full <= limit))
        assert (dist[who == i] == full[entry[who == i]]).all()


def test_ties_hot_codes_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "INDEX_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = [(i, int(c)) for i, c in enumerate(rng.integers(-2**63, 2**63, 200))] + [(1000 + i, 12345) for i in range(100)]
    codes = rows + [rows[3], (None, 5), (77777, None)]
    df = spark.createDataFrame(codes, "id long, code long")
    got = sorted(map(tuple, topk.top_k(df, df.where("id % 50 = 0"), k=6).collect()))
    assert got == brute(rows, [r for r in rows if r[0] % 50 == 0], 6)
    assert topk.top_k(df.where("false"), df, 3).count() == 0
    assert topk.top_k(df, df.where("false"), 3).count() == 0


def test_codes_of_short_and_null_vectors(spark):
    df = spark.createDataFrame([([1.0, -1.0, None, 0.5],), ([0.0] * 63 + [2.0],), ([],)], "embedding array<float>")
    assert [r[0] for r in df.select(topk.sign_code()).collect()] == [0b1001, -2**63, 0]


def test_longer_vectors_are_refused(spark):
    df = spark.createDataFrame([([1.0] * 65,)], "embedding array<float>")
    with pytest.raises(Exception, match="64 components"):
        df.select(topk.sign_code()).collect()


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = sorted(map(tuple, QUERIES["op1_multi_index_hashing"](spark, sf).collect()))
    assert got == sorted(con.execute(topk.ORACLE).fetchall())
