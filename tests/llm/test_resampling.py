import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import resampling
from sparkmart.llm._common import utf8

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH = ["alpha beta gamma delta", None, "", "Alpha omega 日本 éÉ", "beta beta"]


def grams(text, widths):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i:i + n]) for n in range(widths[0], widths[1] + 1) for i in range(len(w) - n + 1)], len(w)


def brute(docs, bench, share, min_words, widths, buckets, seed):
    crc = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for g in grams(text, widths)[0]:
            s[crc(g)] += 1
    for text in bench:
        for g in grams(text, widths)[0]:
            t[crc(g)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        g, n = grams(text, widths)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc(x)] for x in g)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = len(order) * share[0] // share[1]
    out = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(order, 1)]
    return sorted(map(str, out + [(*r[:4], None) for r in rows if r[4] < min_words]))


def corpus(n=300, seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["Alpha", "beta", "GAMMA", "été", "日本", "x" * 70]
    return [(i, rnd.choice([" ", ", ", "\n", "-"]).join(rnd.choices(vocab, k=rnd.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("widths, share, runs", [((1, 1), (10, 100), 256), ((1, 3), (1, 2), 4), ((2, 2), (1, 1), 3), ((1, 1), (0, 1), 4)])
def test_against_brute_force(spark, make, odd, monkeypatch, widths, share, runs):
    monkeypatch.setattr(resampling, "RUNS", runs)
    docs = corpus() + odd + [(700, "the same words again and again " * 5)] * 150 + [(None, "no id at all here " * 8)] * 80
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(BENCH)], "item_id long, text string, score int")
    got = resampling.importance(make(docs, 7), bench, share, 20, widths=widths, buckets=97, seed=11)
    assert got.columns == ["id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, BENCH, share, 20, widths, 97, 11)


def test_small_and_empty_tables(spark, make):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resampling.importance(make([]), bench).count() == 0
    docs = [(1, "a b c"), (2, None), (3, " ".join(map(str, range(30))))]
    got = resampling.importance(make(docs), bench, (1, 1))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(docs, [], (1, 1), 20, (1, 1), 10_000, 2024)


def test_draw_returns_documents_as_they_came(spark, make):
    docs = make(corpus(100))
    bench = spark.createDataFrame([(1, BENCH[0])], "item_id long, text string")
    got = resampling.draw(docs.withColumnRenamed("piece", "weight"), bench, (1, 4), 20)
    assert got.columns == [*[c if c != "piece" else "weight" for c in docs.columns], "_weight", "_rank"]
    ranks = {r.id: r["rank"] for r in resampling.importance(docs, bench, (1, 4), 20).collect()}
    texts = dict(corpus(100))
    rows = got.collect()
    assert {r.doc_id: r["_rank"] for r in rows} == {i: k for i, k in ranks.items() if k} and all(r.text == texts[r.doc_id] for r in rows)


def test_string_ids_and_long_words(spark):
    docs = [(f"d{i % 40}", "word " * 25 + "z" * (i * 300)) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id string, text string").repartition(6)
    got = resampling.importance(frame, frame, (1, 2), 1, buckets=31)
    rows = [tuple(r) for r in got.collect()]
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 61))
    assert [r[3] for r in sorted((r for r in rows if r[4]), key=lambda r: r[4])] == sorted((r[3] for r in rows), reverse=True)[:60]


def test_crc_of_runs_of_words():
    rnd = random.Random(1)
    texts = ["", "a", "é ü", "A-b_c 0", "y" * 500 + " z"] + ["".join(rnd.choice("aZ é日\n.") for _ in range(rnd.randrange(80))) for _ in range(300)]
    data, offsets = utf8(pa.array(texts))
    found, n, words = resampling.features(data, offsets, (1, 4), 1 << 20)
    at = np.concatenate([[0], np.cumsum(n)])
    for k, t in enumerate(texts):
        g, w = grams(t, (1, 4))
        assert words[k] == w and sorted(found[at[k]:at[k + 1]].tolist()) == sorted(zlib.crc32(x.encode()) % (1 << 20) for x in g)
