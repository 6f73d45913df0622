"""Operator 8 - toxicity by a convolutional text classifier.

Words are hashed into a table of learned embeddings (a word's vector is the sum of its
own row and those of its first 4 and 5 bytes, which inflected forms share); filters of several widths run
over the words of a whole text, their largest responses are pooled, and a logistic
layer scores the text.  The network is trained on every labelled row and its whole text:
the rows are dealt by a hash into shards of about ``SHARD`` rows, each shard is trained on
in a task (numpy), and after each of ``ROUNDS`` rounds the shards' networks are averaged,
weighted by their rows, as the start of the next; one shard alone needs one round.  A fifth
of all labelled rows, by a hash, is kept out of a first training: it calibrates the scores
(a logistic map) and gives each language its threshold, from counts of its outputs to two
decimals.  The network in use is trained on all rows.  The language is no input of the
score; it only picks the threshold of the extra decision.

Defined cases: null and empty texts get the score of no words; without labelled
rows, or with one label only, every score is that label's share (0 without any);
languages without both labels in the calibration part use the common threshold; null
languages too; an id with several label rows counts once for each of them, so equal
ones weigh more and contradicting ones teach both labels; an id with several texts
gives each of its labels to all of them; rows of a shard are taken in the order of a hash
of id, text and label; one row comes out for each row that goes in; other columns are kept, but
for those named as ``score_out`` and ``decision_out``, which the results replace.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import hashing
from ._common import id_hash, runs, stored, utf8

#: Labelled rows of a shard (about); rounds and passes over the rows where there are several; pieces that a network is averaged in.
SHARD, ROUNDS, PASSES, PIECES = 7000, 2, 4, 16
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 8, 8, (1, 2, 3)
PREFIXES = (4, 5)
#: Passes over the rows of one shard alone: as many as make STEPS batches, within these bounds.
EPOCHS, STEPS = (8, 60), 600
BATCH, RATE, DECAY = 32, 0.01, 1e-3
#: Share of words blanked in the first training steps (less and less later), so that no text is learned by heart.
DROP = 0.5
THRESHOLD = 0.3

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = hashing.lower_ascii()
PAD = max(WIDTHS) - 1


@dataclass
class WordNet:
    """Embeddings (bucket 0 is padding), per width a filter bank and bias, the output layer, calibration, thresholds."""

    emb: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def params(self) -> list[np.ndarray]:
        return [self.emb, *self.filters, *self.bias, self.out, self.out_bias]


def new_net(seed: int = 7) -> WordNet:
    r = np.random.default_rng(seed)
    emb = r.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    emb[0] = 0
    return WordNet(emb, [r.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   r.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32))


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all rows' words (words x their 1 + len(PREFIXES) rows), each text followed by PAD zeros; offsets (n + 1)."""
    h, at = hashing.words(data, offsets, _WORD, _LOWER, PREFIXES)
    ids = (h.T % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
    rows = len(at) - 1
    out = np.zeros((len(ids) + PAD * rows, ids.shape[1]), np.int32)
    out[np.arange(len(ids)) + PAD * np.repeat(np.arange(rows), np.diff(at))] = ids
    return out, at + PAD * np.arange(rows + 1)


def _pooled(parts: list[np.ndarray], net: WordNet, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(responses with padding at 0, their largest per row); parts: per width and step, n x FILTERS products."""
    n, resp, k = len(ids), [], 0
    for w in WIDTHS:
        r = parts[k].copy()
        for s in range(1, w):
            r[:n - s] += parts[k + s][s:]
        resp.append(r)
        k += w
    resp = np.concatenate(resp, 1)
    resp += np.concatenate(net.bias)
    resp[ids[:, 0] == 0] = 0
    return resp, np.maximum.reduceat(resp, at[:-1], axis=0)


def forward(net: WordNet, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e = net.emb[ids].sum(1)
    resp, top = _pooled([e @ bank[s] for w, bank in zip(WIDTHS, net.filters) for s in range(w)], net, ids, at)
    h = np.maximum(top, 0)
    return resp, h, h @ net.out + net.out_bias


def train(net: WordNet, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed: int = 9, part: tuple[int, int] = (0, 1)) -> WordNet:
    """Adam on the weighted logistic loss; ``texts`` are padded bucket arrays.  ``part`` (k, n): the k-th of n parts of ``PASSES`` epochs."""
    r = np.random.default_rng(seed + part[0])
    p = net.params()
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    n_f = FILTERS
    epochs = PASSES if part[1] > 1 else min(max(-(-STEPS * BATCH // len(texts)), EPOCHS[0]), EPOCHS[1])
    for epoch in range(epochs * part[0] // part[1], epochs * (part[0] + 1) // part[1]):
        drop = DROP * (1 - epoch / epochs)
        order = r.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            take = order[lo:lo + BATCH]
            ids = np.concatenate([texts[i] for i in take])
            ids = np.where(r.random((len(ids), 1)) < drop, 0, ids)
            at = np.concatenate([[0], np.cumsum([len(texts[i]) for i in take])])
            resp, h, z = forward(net, ids, at)
            g = (1 / (1 + np.exp(-z)) - y[take]) * weight[take] / len(take)
            g_h = (g[:, None] * net.out) * (h > 0)
            row = np.repeat(np.arange(len(take)), np.diff(at))
            pos, f = np.nonzero(resp == np.where(h > 0, h, np.inf)[row])
            where = np.zeros(h.shape, np.int64)
            where[row[pos[::-1]], f[::-1]] = pos[::-1]
            g_emb, g_filters, g_bias = np.zeros_like(net.emb), [], []
            for k, (w, bank) in enumerate(zip(WIDTHS, net.filters)):
                gk = g_h[:, k * n_f:(k + 1) * n_f]
                seen = ids[np.minimum(where[:, k * n_f:(k + 1) * n_f, None] + np.arange(w), len(ids) - 1)]  # n x filters x w x rows
                g_filters.append(np.einsum("nf,nfwd->wdf", gk, net.emb[seen].sum(3)) + DECAY * bank)
                g_bias.append(gk.sum(0))
                np.add.at(g_emb, seen, (gk[:, :, None, None] * bank.transpose(2, 0, 1)[None])[:, :, :, None])
            g_emb += DECAY * net.emb
            g_emb[0] = 0
            grads = [g_emb, *g_filters, *g_bias, h.T @ g, np.array([g.sum()])]
            t += 1
            for a, ga, ma, va in zip(p, grads, m, v):
                ma += 0.1 * (ga - ma)
                va += 0.001 * (ga * ga - va)
                a -= RATE * (ma / (1 - 0.9 ** t)) / (np.sqrt(va / (1 - 0.999 ** t)) + 1e-8)
    return net


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale (kept positive) and shift of a logistic map from outputs to the labels' rates, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        # a weak pull towards the map that changes nothing keeps the steps finite where the labels are separable
        ga, gb = (weight * (q - y) * z).sum() + (a - 1), (weight * (q - y)).sum() + b * 0.1
        s = weight * q * (1 - q)
        haa, hab, hbb = (s * z * z).sum() + 1, (s * z).sum(), s.sum() + 0.1
        d = haa * hbb - hab * hab
        a, b = a - np.clip((hbb * ga - hab * gb) / d, -1, 1), b - np.clip((haa * gb - hab * ga) / d, -1, 1)
        a = max(a, 0.05)
    return float(a), float(b)


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the largest weighted F1 (the midpoint below the best cut)."""
    order = np.argsort(-score, kind="stable")
    s, yy, w = score[order], y[order], weight[order]
    hit, told = np.cumsum(w * yy), np.cumsum(w)
    f1 = 2 * hit / (told + (w * yy).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def labelled(docs: DataFrame, labels: DataFrame, learn, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Every usable label with its text: (y, t, lang, h, rest); ``rest``: kept out of the first training."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & learn)
             .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                        (F.col("lang") if "lang" in docs.columns else F.lit(None)).cast("string").alias("lang"))
    # merged at any size: labels grow with the documents
    return (known.join(texts.hint("merge"), "id").withColumn("h", id_hash("id", "t", "y"))
            .select("y", "t", "lang", "h", (F.pmod(F.xxhash64("h"), F.lit(5)) == 0).alias("rest")))


def _bucketed(texts: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    data, offsets = utf8(texts)
    out = []
    for i, j in runs(offsets, 1 << 18):  # hashing takes many times the bytes it is given
        ids, at = word_ids(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        out += [ids[a:b] for a, b in zip(at[:-1], at[1:])]
    return out


def _flat(net: WordNet) -> np.ndarray:
    return np.concatenate([a.ravel() for a in net.params()])


def _unflat(flat: np.ndarray) -> WordNet:
    net, at = new_net(), 0
    for a in net.params():
        a[...] = flat[at:at + a.size].reshape(a.shape)
        at += a.size
    return net


def _trained(sent, part: tuple[int, int]):
    """Grouped-map body: one shard's rows -> the pieces of its networks (0: of the rows not kept out, 1: of all) after these epochs."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("y", "ascending")])
        texts, y, rest = _bucketed(t["t"]), t["y"].to_numpy().astype(np.float32), t["rest"].to_numpy()
        out = {"net": [], "piece": [], "rows": [], "part": []}
        for k, flat in enumerate(sent.value):
            take = np.flatnonzero(~rest) if k == 0 else np.arange(len(y))
            if len(take):
                flat = _flat(train(_unflat(flat), [texts[i] for i in take], y[take], np.ones(len(take), np.float32), part=part))
            out["net"] += [k] * PIECES
            out["piece"] += range(PIECES)
            out["rows"] += [len(take)] * PIECES
            out["part"] += [p.astype(np.float32).tobytes() for p in np.array_split(flat, PIECES)]
        return pa.table(out, pa.schema([("net", pa.int32()), ("piece", pa.int32()), ("rows", pa.int64()), ("part", pa.binary())]))
    return run


def _mean(t: pa.Table) -> pa.Table:
    """One piece of all shards' networks -> their mean, weighted by rows, in an order that no task decides."""
    total, n = 0.0, 0
    for m, p in sorted(zip(t["rows"].to_pylist(), t["part"].to_pylist())):
        total, n = total + m * np.frombuffer(p, np.float32).astype(float), n + m
    return pa.table({"net": t["net"].slice(0, 1), "piece": t["piece"].slice(0, 1), "part": pa.array([(total / max(n, 1)).astype(np.float32).tobytes()], pa.binary())})


def train_shards(rows: DataFrame, n: int) -> list[WordNet]:
    """Networks trained on the rows (y, t, h, rest) that are not kept out, and on all ``n``: shard by shard, averaged after each round."""
    shards = max(1, round(n / SHARD))
    flats, rounds = [_flat(new_net())] * 2, ROUNDS if shards > 1 else 1
    shard = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards))
    dealt = rows.select("y", "t", "h", "rest", shard.alias("shard")).repartition(4 * shards, "shard")  # so that few meet in one task
    for k in range(rounds):
        sent = rows.sparkSession.sparkContext.broadcast(flats)
        trained = dealt.groupBy("shard").applyInArrow(_trained(sent, (k, rounds)), "net int, piece int, rows long, part binary")
        parts = sorted(trained.groupBy("net", "piece").applyInArrow(_mean, "net int, piece int, part binary").collect(), key=lambda p: (p.net, p.piece))
        flats = [np.concatenate([np.frombuffer(p.part, np.float32) for p in parts if p.net == i]) for i in (0, 1)]  # two networks
        sent.unpersist()
    return [_unflat(f) for f in flats]


def outputs(rows: DataFrame, net: WordNet) -> list:
    """How many of ``rows`` have which (lang, y, output of the network to two decimals)."""
    sent = rows.sparkSession.sparkContext.broadcast(_flat(net))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _unflat(sent.value)
        for b in batches:
            z = np.array([forward(own, ids, np.array([0, len(ids)]))[2][0] for ids in _bucketed(b.column("t"))], float)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("y"), pa.array(np.round(z, 2), pa.float64())], ["lang", "y", "z"])

    return rows.select("lang", "y", "t").mapInArrow(score, "lang string, y int, z double").groupBy("lang", "y", "z").count().collect()


def fit(docs: DataFrame, labels: DataFrame, learn=None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> WordNet:
    """Train and calibrate on the labelled rows for which ``learn`` (a condition on the id) holds."""
    ship(docs.sparkSession)
    rows = stored(labelled(docs, labels, F.lit(True) if learn is None else learn, id_col, text_col, label_col), "toxicity")
    counts = {(r.y, r.rest): r["count"] for r in rows.groupBy("y", "rest").count().collect()}
    have = {(y, rest): counts.get((y, rest), 0) for y in (0, 1) for rest in (False, True)}
    label = {y: have[y, False] + have[y, True] for y in (0, 1)}
    if not label[0] or not label[1]:
        net = new_net()
        net.out[:] = 0
        net.out_bias[:] = 20.0 if label[1] else -20.0
        return net
    first, last = train_shards(rows, label[0] + label[1])
    if not all(have.values()):
        return last  # too few rows to keep some out
    told = sorted(outputs(rows.where("rest"), first), key=lambda r: (r.lang or "", r.y, r.z))
    z, y = np.array([r.z for r in told]), np.array([r.y for r in told], float)
    weight, tongue = np.array([r["count"] for r in told], float), np.array([r.lang or "" for r in told])
    last.scale, last.shift = calibrate(z, y, weight)
    score = 1 / (1 + np.exp(-(last.scale * z + last.shift)))
    for one in sorted(set(tongue)):
        mine = tongue == one
        if one and 0 < y[mine].sum() < mine.sum():
            last.thresholds[one] = best_threshold(score[mine], y[mine], weight[mine])
    return last


class Scorer:
    """The network in use: each bucket's products with all filters are one row of a table."""

    def __init__(self, net: WordNet):
        self.net = net
        self.table = np.concatenate([net.emb @ bank[s] for w, bank in zip(WIDTHS, net.filters) for s in range(w)], 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        net, out = self.net, np.zeros(len(offsets) - 1)
        steps = range(sum(WIDTHS))
        for i, j in runs(offsets, 1 << 18):
            ids, at = word_ids(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            g = self.table.take(ids[:, 0], axis=0)
            for k in range(1, ids.shape[1]):
                g += self.table.take(ids[:, k], axis=0)
            top = _pooled([g[:, k * FILTERS:(k + 1) * FILTERS] for k in steps], net, ids, at)[1]
            z = np.maximum(top, 0) @ net.out + net.out_bias
            out[i:j] = 1 / (1 + np.exp(-np.clip(net.scale * z.astype(float) + net.shift, -40, 40)))
        return out


_worker: dict[str, Scorer] = {}


def with_toxicity(docs: DataFrame, net: WordNet, text_col: str = "text", lang_col: str = "lang", score_out: str = "score",
                  decision_out: str = "toxic_in_lang") -> DataFrame:
    """``docs`` with the score of each whole text, and the decision by its language's threshold."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net))
    key = hashlib.md5(sent.value).hexdigest()

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _worker:
            _worker.clear()
            _worker[key] = Scorer(pickle.loads(sent.value))
        for b in batches:
            yield pa.array(_worker[key](*utf8(b)), pa.float64())

    limit = F.lit(THRESHOLD)
    for one, t in sorted(net.thresholds.items()):
        if lang_col in docs.columns:
            limit = F.when(F.col(lang_col) == one, F.lit(t)).otherwise(limit)
    got = f"_{uuid.uuid4().hex}"
    return (docs.withColumn(got, score(F.col(text_col))).withColumn(score_out, F.col(got))
            .withColumn(decision_out, F.col(got) >= limit).drop(got))
