"""Operator 9 - language identification by a byte convolutional network.

Bytes have learned embeddings; filters of several widths run over fixed-length
windows of a text, their largest responses are pooled, and a softmax layer gives
the languages.  The network is trained in numpy on the driver, on a bounded sample
of labelled windows (``PER_LANG`` documents a language, fewer where there are so many
languages that these would be more than ``DOCS``, and ``WINDOWS`` windows of each; every
label that occurs is learned), and applied in batches to all windows of every whole text inside tasks.  A
text's scores are the means of its windows' probabilities, weighted by their letters.

In use, a filter's response is a sum of table entries: for each width, pairs of
neighbouring bytes index tables of 65,536 rows that hold the same products that the
embedding and the filter would give.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without
any labelled row everything is ``und``; with one language all texts with letters get
it; one row comes out for each row that goes in; ties go to the first language by
name; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from ._common import id_hash, runs, thinned, utf8

#: The training sample: documents of each language, documents in all (but one of each language), windows of each document.
PER_LANG, DOCS, WINDOWS = 400, 80_000, 4
LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS, DIM = 16, 8
EPOCHS, BATCH, RATE = 6, 64, 0.01


@dataclass
class ByteNet:
    """Embedding (256 x DIM), per width a filter bank (width x DIM x FILTERS) and bias, and the output layer."""

    langs: list[str]
    emb: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [self.emb, *self.filters, *self.bias, self.out, self.out_bias]


def new_net(langs: list[str], seed: int = 3) -> ByteNet:
    r = np.random.default_rng(seed)
    emb = r.normal(0, 0.5, (256, DIM)).astype(np.float32)
    emb[0] = 0  # padding
    banks = [r.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    return ByteNet(langs, emb, banks, [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))


def train(net: ByteNet, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> ByteNet:
    """Adam on the cross-entropy of windows ``x`` (n x LENGTH bytes) with labels ``y``."""
    r = np.random.default_rng(seed)
    p = net.params()
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for lo in range(0, len(x), BATCH):
            take = order[lo:lo + BATCH]
            xb, yb = x[take], y[take]
            n = len(xb)
            e = net.emb[xb]
            pooled, where = [], []
            for w, bank, bias in zip(WIDTHS, net.filters, net.bias):
                span = LENGTH - w + 1
                resp = sum(e[:, k:k + span] @ bank[k] for k in range(w)) + bias
                at = resp.argmax(1)
                where.append(at)
                pooled.append(np.take_along_axis(resp, at[:, None], 1)[:, 0])
            raw = np.concatenate(pooled, 1)
            h = np.maximum(raw, 0)
            z = h @ net.out + net.out_bias
            z -= z.max(1, keepdims=True)
            q = np.exp(z)
            q /= q.sum(1, keepdims=True)
            q[np.arange(n), yb] -= 1
            q /= n
            g_h = (q @ net.out.T) * (raw > 0)
            g_emb, g_filters, g_bias = np.zeros_like(net.emb), [], []
            for k, (w, bank) in enumerate(zip(WIDTHS, net.filters)):
                g = g_h[:, k * FILTERS:(k + 1) * FILTERS]
                idx = where[k][:, :, None] + np.arange(w)  # n x filters x w
                seen = xb[np.arange(n)[:, None, None], idx]
                patch = net.emb[seen]  # n x filters x w x dim
                g_filters.append(np.einsum("nf,nfwd->wdf", g, patch))
                g_bias.append(g.sum(0))
                np.add.at(g_emb, seen, g[:, :, None, None] * bank.transpose(2, 0, 1)[None])
            g_emb[0] = 0
            grads = [g_emb, *g_filters, *g_bias, h.T @ q, q.sum(0)]
            t += 1
            for a, ga, ma, va in zip(p, grads, m, v):
                ma += 0.1 * (ga - ma)
                va += 0.001 * (ga * ga - va)
                a -= RATE * (ma / (1 - 0.9 ** t)) / (np.sqrt(va / (1 - 0.999 ** t)) + 1e-8)
    return net


class Tables:
    """The filters' responses, by pairs of neighbouring bytes."""

    def __init__(self, net: ByteNet):
        self.net = net
        self.steps: list[list[tuple[int, np.ndarray, bool]]] = []
        for w, bank in zip(WIDTHS, net.filters):
            one = [net.emb @ bank[k] for k in range(w)]  # 256 x FILTERS each
            steps = [(k, (one[k][:, None] + one[k + 1][None]).reshape(65536, FILTERS), True) for k in range(0, w - 1, 2)]
            if w % 2:
                steps.append((w - 1, one[w - 1], False))
            self.steps.append(steps)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Languages' probabilities for windows ``x`` (n x LENGTH bytes)."""
        net, out = self.net, []
        for lo in range(0, len(x), 64):
            b = x[lo:lo + 64]
            pairs = b[:, :-1].astype(np.int32) << 8 | b[:, 1:]
            pooled = []
            for w, steps, bias in zip(WIDTHS, self.steps, net.bias):
                span, resp = LENGTH - w + 1, None
                for k, table, pair in steps:
                    part = table.take((pairs if pair else b)[:, k:k + span], axis=0)
                    resp = part if resp is None else np.add(resp, part, out=resp)
                pooled.append(resp.max(1) + bias)
            z = np.maximum(np.concatenate(pooled, 1), 0) @ net.out + net.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(net.langs)), np.float32)


#: Bytes that letters are written with (A-Z, a-z and whatever is beyond ASCII).
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (n x LENGTH, padded with 0) of all rows one after another, and each window's row.

    A row's windows follow each other; neighbours share the bytes that the widest filter needs.
    """
    step = LENGTH - max(WIDTHS) + 1
    length = np.diff(offsets)
    n = np.maximum(1, -(-(length - max(WIDTHS) + 1) // step))
    n[length == 0] = 0
    row = np.repeat(np.arange(len(length)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][row] + k * step
    at = start[:, None] + np.arange(LENGTH)
    x = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    x[at >= offsets[1:][row][:, None]] = 0
    return x, row


def score_rows(tables: Tables, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of each row's windows, by their letters (rows x languages)."""
    rows = len(offsets) - 1
    total = np.zeros((rows, len(tables.net.langs)), np.float64)
    for i, j in runs(offsets, 1 << 20):
        x, row = cut_windows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        if len(x):
            weight = _LETTER[x].sum(1) + 1e-3
            np.add.at(total[i:j], row, tables.probabilities(x) * weight[:, None])
    some = total.sum(1, keepdims=True)
    return np.divide(total, some, out=total, where=some > 0)


def training_windows(docs: DataFrame, text_col: str, lang_col: str, order: list[str], per_lang: int) -> list:
    """(lang, window text) of a bounded sample: the first ``per_lang`` documents of each language by a hash of order and text."""
    size = LENGTH  # characters; cut to bytes afterwards
    last = F.greatest(F.length("t") - size, F.lit(0))
    starts = [F.floor(last * k / max(WINDOWS - 1, 1)).cast("int") + 1 for k in range(WINDOWS)]
    row = Window.partitionBy("lang").orderBy("h", "t")
    usable = (docs.where(F.col(text_col).rlike(r"\p{L}") & F.col(lang_col).isNotNull())
              .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"), id_hash(*order, text_col).alias("h")))
    # distinct hashes count, so that repeated rows thin nothing out
    counts = {r[0]: r[1] for r in usable.select("lang", "h").distinct().groupBy("lang").count().collect()}
    per_lang = max(1, min(per_lang, DOCS // max(len(counts), 1)))
    return (thinned(usable, "lang", "h", dict.fromkeys(counts, per_lang), counts)
            .select("lang", "h", F.array_distinct(F.array(*[F.substr("t", s, F.lit(size)) for s in starts])).alias("t"))
            .dropDuplicates(["lang", "h"])
            .withColumn("k", F.row_number().over(row)).where(F.col("k") <= per_lang)
            .select("lang", F.explode("t").alias("t")).collect())


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: list[str] | None = None,
        per_lang: int = PER_LANG) -> ByteNet | None:
    """Train on ``docs``' labelled rows; None if there are none."""
    rows = training_windows(docs, text_col, lang_col, order or ["doc_id"], per_lang)
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    x = np.zeros((len(rows), LENGTH), np.uint8)
    for i, r in enumerate(rows):
        b = np.frombuffer(r[1].encode()[:LENGTH], np.uint8)
        x[i, :len(b)] = b
    place = {lang: k for k, lang in enumerate(langs)}
    y = np.array([place[r[0]] for r in rows])
    return train(new_net(langs), x, y)


_worker: dict[str, Tables] = {}


def with_language(docs: DataFrame, net: ByteNet | None, text_col: str = "text", lang_out: str = "lang_pred",
                  score_out: str = "score") -> DataFrame:
    """``docs`` with the language that the network gives each whole text, and its score."""
    if net is None:
        return docs.withColumn(lang_out, F.lit("und")).withColumn(score_out, F.lit(0.0))
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net))
    key = hashlib.md5(sent.value).hexdigest()
    langs = net.langs

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _worker:
            _worker.clear()
            _worker[key] = Tables(pickle.loads(sent.value))
        for b in batches:
            p = score_rows(_worker[key], *utf8(b))
            best = p.argmax(1)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()).take(pa.array(best, pa.int64())),
                                              pa.array(p[np.arange(len(p)), best], pa.float64())], ["lang", "score"])

    got = f"_{uuid.uuid4().hex}"
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return (docs.withColumn(got, predict(F.col(text_col)))
            .withColumn(lang_out, F.when(known, F.col(f"{got}.lang")).otherwise(F.lit("und")))
            .withColumn(score_out, F.when(known, F.least(F.col(f"{got}.score"), F.lit(1.0))).otherwise(F.lit(0.0))).drop(got))
