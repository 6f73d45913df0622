import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sparkmart.llm import toxicity
from sparkmart.llm._common import utf8
from sparkmart.llm.queries import QUERIES


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_query_on_the_held_out_fold(spark, sf):
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity_cnn"](spark, sf).collect()}
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    y = {i: t for i, t in zip(labels["doc_id"], labels["toxic"]) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in rows.items())
    assert auc(np.array([rows[i].score for i in y]), np.array(list(y.values()))) > 0.75  # some 30 toxic texts to learn from


def toy(n=240):
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        w = list(rng.choice(vocab, 30))
        if i % 3 == 0:
            w[rng.integers(30)] = rng.choice(["idiot", "vilex", "viley", "vilez"])
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    return rows


def test_learns_words_and_their_stems(spark):
    rows = toy()
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (9999, 0)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels, learn=F.col("doc_id") < 180)
    new = [(1, "w1 w2 idiot w3"), (2, "w5 w6 w7"), (3, "w9 vilequ w2"), (4, None), (5, ""), (None, "w1 w2"), (6, "w3 " * 40_000 + "idiot")]
    out = toxicity.with_toxicity(spark.createDataFrame([(*r, 1.5) for r in new], "doc_id long, text string, score double"), net).collect()
    score = {r.doc_id: r.score for r in out}
    assert len(out) == len(new) and min(score[1], score[3], score[6]) > 0.5 > max(score[2], score[4], score[5])
    assert score[4] == score[5]


def test_whole_texts_and_one_score_whatever_the_batch():
    net = toxicity.new_net(1)
    net.emb[:] = np.random.default_rng(2).normal(0, 1, net.emb.shape)
    net.emb[0] = 0
    texts = ["a b c d", "", "e f", "g " * 3000, "h"]
    score = toxicity.Scorer(net)
    together = score(*utf8(pa.array(texts)))
    alone = [score(*utf8(pa.array([t])))[0] for t in texts]
    assert np.allclose(together, alone)


def plain_score(net, words):
    """One text's output, position by position: the products of every window, its largest response, the last layer."""
    ids = np.concatenate([words, np.zeros((toxicity.PAD, words.shape[1]), int)]) if len(words) else np.zeros((toxicity.PAD, words.shape[1]), int)
    vectors, pooled = net.emb[ids].sum(1), []
    for w, bank, bias in zip(toxicity.WIDTHS, net.filters, net.bias):
        best = np.zeros(toxicity.FILTERS)
        for i in range(len(words)):
            best = np.maximum(best, sum((vectors[i + k] @ bank[k] for k in range(w) if i + k < len(vectors)), bias.copy()))
        pooled.append(best)
    return float(np.concatenate(pooled) @ net.out + net.out_bias[0])


def spread(net, seed=2):
    rng = np.random.default_rng(seed)
    for a in net.params():
        a[:] = rng.normal(0, 0.5, a.shape)
    net.emb[0] = 0
    return net


def test_scorer_and_forward_equal_the_plain_network():
    net = spread(toxicity.new_net(1))
    net.scale, net.shift = 0.3, -0.2
    texts = ["a b c d", "", "e f", "g h " * 40, "h", "longer words with prefixes: prefixed prefixing"]
    data, offsets = utf8(pa.array(texts))
    ids, at = toxicity.word_ids(data, offsets)
    z = np.array([plain_score(net, ids[at[k]:at[k + 1] - toxicity.PAD]) for k in range(len(texts))])
    assert np.allclose(toxicity.forward(net, ids, at)[2], z, atol=1e-3)
    assert np.allclose(toxicity.Scorer(net)(data, offsets), 1 / (1 + np.exp(-(0.3 * z - 0.2))), atol=1e-4)


def test_first_step_goes_down_the_numeric_gradient(monkeypatch):
    """Adam's first step is the rate against the sign of each gradient, so it shows them all."""
    for name, value in {"DROP": 0.0, "STEPS": 1, "EPOCHS": (1, 1), "DECAY": 0.0, "BUCKETS": 60}.items():
        monkeypatch.setattr(toxicity, name, value)
    texts = []
    for t in ("a b c d e", "f g", "h i j k", "l a"):
        b = np.frombuffer(t.encode(), np.uint8)
        texts.append(toxicity.word_ids(b, np.array([0, len(b)]))[0])
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def net():
        n = spread(toxicity.new_net())
        n.emb, n.out, n.out_bias = n.emb.astype(float), n.out.astype(float), n.out_bias.astype(float)
        n.filters, n.bias = [f.astype(float) for f in n.filters], [b.astype(float) for b in n.bias]
        return n

    def loss(n):
        z = np.array([toxicity.forward(n, t, np.array([0, len(t)]))[2][0] for t in texts])
        return (weight * (np.logaddexp(0, z) - y * z)).mean()

    start, moved, checked = net(), toxicity.train(net(), texts, y, weight), 0
    rng = np.random.default_rng(3)
    for a, after in zip(start.params(), moved.params()):
        for k in rng.choice(a.size, min(a.size, 60), replace=False):
            if a is start.emb and k < a.shape[1]:
                continue  # the padding row
            at, was = np.unravel_index(k, a.shape), a.flat[k]
            a[at] = was + 1e-6
            up = loss(start)
            a[at] = was - 1e-6
            slope = (up - loss(start)) / 2e-6
            a[at] = was
            if abs(slope) > 1e-5:
                assert abs((after[at] - was) + toxicity.RATE * np.sign(slope)) < 1e-4
                checked += 1
            else:
                assert abs(after[at] - was) <= toxicity.RATE * 1.0001
    assert checked > 80


def test_contradicting_and_repeated_labels(spark):
    docs = spark.createDataFrame([(i, f"word{i} same text") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i in range(20) for y in (0, 1)] + [(3, 1), (3, 1)], "doc_id long, toxic int")
    out = toxicity.with_toxicity(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == 20 and all(0 <= r.score <= 1 for r in out)


def test_without_labels_or_with_one(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [round(r.score, 3) for r in toxicity.with_toxicity(docs, toxicity.fit(docs, none)).collect()] == [0, 0]
    assert [round(r.score, 3) for r in toxicity.with_toxicity(docs, toxicity.fit(docs, one)).collect()] == [1, 1]
    assert toxicity.with_toxicity(docs.where("false"), toxicity.fit(docs, none)).count() == 0


def test_calibration_and_threshold():
    z = np.array([-3.0, -2, -1, 1, 2, 3])
    y = np.array([0, 0, 1, 0, 1, 1])
    a, b = toxicity.calibrate(z, y, np.ones(6))
    assert a > 0 and abs((1 / (1 + np.exp(-(a * z + b)))).mean() - 0.5) < 0.05
    assert 0.2 < toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0]), np.ones(4)) < 0.8


def test_every_labelled_row_and_its_whole_text_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 60)
    docs = spark.createDataFrame([(i, ("w%d " % (i % 7)) * (12_000 if i == 3 else 5)) for i in range(240)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)], "doc_id long, toxic int")
    rows = toxicity.labelled(docs, labels, F.lit(True), "doc_id", "text", "toxic")
    assert rows.count() == 240 and rows.agg(F.max(F.length("t"))).first()[0] == 36_000  # neither rows nor long texts are left out
    seen, real = [], toxicity._trained

    def spy(sent, part):
        seen.append(part)
        return real(sent, part)

    monkeypatch.setattr(toxicity, "_trained", spy)
    nets = toxicity.train_shards(rows, 240)
    assert seen == [(k, toxicity.ROUNDS) for k in range(toxicity.ROUNDS)] and all(np.isfinite(net.emb).all() for net in nets)


def test_shards_are_averaged_by_their_rows():
    part = lambda v: np.full(3, v, np.float32).tobytes()
    t = pa.table({"net": pa.array([1, 1], pa.int32()), "piece": pa.array([2, 2], pa.int32()), "rows": [1, 3], "part": pa.array([part(4), part(8)], pa.binary())})
    out = toxicity._mean(t).to_pylist()
    assert out[0]["piece"] == 2 and np.allclose(np.frombuffer(out[0]["part"], np.float32), 7)


def test_learns_over_several_shards(spark, monkeypatch):
    rows = toy(1200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SHARD", 400)
    net = toxicity.fit(docs, labels, learn=F.col("doc_id") < 900)
    out = {r.doc_id: r.score for r in toxicity.with_toxicity(docs, net).collect()}
    y = np.array([y for i, _, y in rows if i >= 900])
    assert auc(np.array([out[i] for i, _, _ in rows if i >= 900]), y) > 0.9
