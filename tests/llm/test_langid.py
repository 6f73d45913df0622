import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from sparkmart.llm import langid
from sparkmart.llm._common import utf8
from sparkmart.llm.queries import QUERIES


def test_query_on_the_held_out_fold(spark, sf):
    rows = QUERIES["op9_language_id"](spark, sf).collect()
    lang = dict(zip(*pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "lang"]).to_pydict().values()))
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_tables_equal_the_convolution():
    net = langid.new_net(["a", "b", "c"])
    x = np.random.default_rng(0).integers(0, 256, (5, langid.LENGTH), dtype=np.uint8)
    pooled = []
    for w, bank, bias in zip(langid.WIDTHS, net.filters, net.bias):
        e = net.emb[x]
        span = langid.LENGTH - w + 1
        pooled.append(np.maximum((sum(e[:, k:k + span] @ bank[k] for k in range(w)) + bias).max(1), 0))
    z = np.concatenate(pooled, 1) @ net.out + net.out_bias
    p = np.exp(z - z.max(1, keepdims=True))
    assert np.allclose(langid.Tables(net).probabilities(x), p / p.sum(1, keepdims=True), atol=1e-4)


def test_windows_cover_whole_texts():
    texts = ["", "a", "b" * 300, "c" * 1000, "é" * 500]
    data, offsets = utf8(pa.array(texts))
    x, row = langid.cut_windows(data, offsets)
    share = max(langid.WIDTHS) - 1
    for i, t in enumerate(texts):
        mine = x[row == i]
        raw = b"".join(bytes(w[:langid.LENGTH - share]) for w in mine[:-1]) + bytes(mine[-1]).rstrip(b"\0") if len(mine) else b""
        assert raw == t.encode()


def test_odd_rows(spark, make, odd):
    docs = make(odd + [(90, "12 34 !"), (91, None)])
    net = langid.train(langid.new_net(["aa", "bb"]), np.full((8, langid.LENGTH), 97, np.uint8), np.array([0, 1] * 4), epochs=1)
    out = langid.with_language(docs, net).collect()
    assert len(out) == len(odd) + 2 and out[0].source == "s"
    for r in out:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (r.score == 0) == (not letters)
    assert langid.with_language(make([]), net).count() == 0
    assert langid.fit(docs.where("false")) is None
    assert {r.lang_pred for r in langid.with_language(docs, None).collect()} == {"und"}
    assert langid.fit(docs, order=["doc_id"]).langs == ["en"]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"some text number {i}", "en" if i % 9 else "fr") for i in range(900)], "doc_id long, text string, lang string")
    rows = langid.training_windows(docs, "text", "lang", ["doc_id"], 30)
    assert sum(r[0] == "en" for r in rows) == sum(r[0] == "fr" for r in rows) == 30


def test_every_label_is_learned(spark):
    schema = "doc_id long, text string, lang string"
    one_id = spark.createDataFrame([(None if i % 2 else 7, f"some text number {i}", "en" if i % 2 else "fr") for i in range(3000)], schema)
    assert [sum(r[0] == x for r in langid.training_windows(one_id, "text", "lang", ["doc_id"], 30)) for x in ("en", "fr")] == [30, 30]
    same = spark.createDataFrame([(7, "the same text", "en")] * 3000, schema)
    assert [tuple(r) for r in langid.training_windows(same, "text", "lang", ["doc_id"], 30)] == [("en", "the same text")]
    many = spark.createDataFrame([(i, f"text {i}", f"l{i % 450}") for i in range(900)], schema)
    assert {r[0] for r in langid.training_windows(many, "text", "lang", ["doc_id"], 5)} == {f"l{k}" for k in range(450)}


def test_first_step_goes_down_the_numeric_gradient(monkeypatch):
    """Adam's first step is the rate against the sign of each gradient, so it shows them all."""
    monkeypatch.setattr(langid, "LENGTH", 12)
    rng = np.random.default_rng(1)
    x, y = rng.integers(1, 256, (6, 12), dtype=np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def net():
        n = langid.new_net(["a", "b", "c"])
        n.emb, n.out, n.out_bias = n.emb.astype(float), n.out.astype(float), n.out_bias.astype(float)
        n.filters, n.bias = [f.astype(float) for f in n.filters], [b.astype(float) for b in n.bias]
        return n

    def loss(n):
        total = 0.0
        for row, label in zip(x, y):
            h = [max(0.0, max(sum(n.emb[row[i + k]] @ bank[k][:, f] for k in range(w)) + bias[f] for i in range(12 - w + 1)))
                 for w, bank, bias in zip(langid.WIDTHS, n.filters, n.bias) for f in range(langid.FILTERS)]
            z = np.array(h) @ n.out + n.out_bias
            total += np.log(np.exp(z - z.max()).sum()) + z.max() - z[label]
        return total / len(x)

    start, moved, checked = net(), langid.train(net(), x, y, epochs=1), 0
    for a, after in zip(start.params(), moved.params()):
        for k in rng.choice(a.size, min(a.size, 20), replace=False):
            at, was = np.unravel_index(k, a.shape), a.flat[k]
            a[at] = was + 1e-6
            up = loss(start)
            a[at] = was - 1e-6
            slope = (up - loss(start)) / 2e-6
            a[at] = was
            if abs(slope) > 1e-5:
                assert abs((after[at] - was) + langid.RATE * np.sign(slope)) < 1e-4
                checked += 1
    assert checked > 30
