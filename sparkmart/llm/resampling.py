"""Operator 13 - importance resampling towards a target distribution, ranked by a parallel sort with regular sampling.

Features are all runs of ``widths`` consecutive words (words by op 5's alphabet, A-Z in
lower case), joined by one space; a feature's bucket is the crc32 of its bytes modulo
``buckets``.  The corpus and the target give two counts a bucket, these give one integer
gain a bucket, and a document's weight is the sum of its features' gains: gains are one
array of ``buckets`` entries that every task has, and a batch of documents is scored by
one lookup of all its buckets.  Adding a Gumbel variate that depends on the id alone makes
the highest scores a sample without replacement in proportion to exp(weight).

Ranks come from a parallel sort by regular sampling:

1. the scored table is cut into at most ``RUNS`` runs, each sorted where it lies (no
   exchange; the sort spills), which numbers its rows;
2. every run hands regular samples to the driver, in all at most the square of the number
   of runs; the sorted samples give regular splitters, which keeps each segment below
   about twice its share;
3. rows carry (run, position) as the last part of their key, so keys are all different and
   a score that a third of all rows have is still cut;
4. counts of rows by segment (``RUNS`` numbers) give each segment's first rank; segments
   that begin behind the last drawn rank are not exchanged at all;
5. the other segments are exchanged by their number, merged by a local sort and counted
   through: rank = rows of all segments before + place in the segment.

Defined cases: null and empty texts have no features, weight 0 and are not drawn for they
have too few words; a null id hashes as the empty string and comes after all others in
ties; rows with one id and one score are ordered by their number of features, equal rows
each have a rank of their own; an empty target or table works on zero counts; other
columns are read by ``draw`` only, and come back unchanged.  Ids are integers or strings.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._common import fresh, runs, stored, text_or_empty, utf8
from .hashing import lower_ascii, run_bounds

#: Runs and segments of the parallel sort; the driver sees at most RUNS * RUNS samples (2 MB).
RUNS = 256
#: Bytes of text that the numpy kernel takes at once, and bytes a word from which zlib is faster.
CHUNK, LONG = 1 << 22, 48


def _crc_table() -> np.ndarray:
    """The byte table of crc32 (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _crc_more(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Finished crc32 values ``state`` continued by the byte runs [start, end)."""
    out = np.empty(len(state), np.uint32)
    size = end - start
    far = np.flatnonzero(size > LONG)
    for i in far:
        out[i] = zlib.crc32(data[start[i]:end[i]], int(state[i]))
    near = np.flatnonzero(size <= LONG)
    near = near[np.argsort(-size[near], kind="stable")]  # the words with a k-th byte are always a front part
    crc, at, left = ~state[near], start[near], -size[near]
    for k in range(int(-left[0]) if len(left) else 0):
        n = int(np.searchsorted(left, -k, "left"))
        crc[:n] = table[(crc[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out[near] = ~crc
    return out


def word_bytes() -> np.ndarray:
    """Bytes of words after lower-casing: digits, a-z and all of other scripts."""
    b = np.zeros(256, bool)
    b[48:58] = b[97:123] = b[128:] = True
    return b


def features(data: np.ndarray, offsets: np.ndarray, widths: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all features in row order, features a row, words a row) of UTF-8 texts."""
    n_rows = len(offsets) - 1
    lo, hi = widths
    data = lower_ascii()[data]
    start, end = run_bounds(word_bytes()[data].view(np.uint8), offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    first = np.searchsorted(start, offsets)
    n_words = np.diff(first)
    row = np.repeat(np.arange(n_rows), n_words)
    table, found, of = _crc_table(), [], []
    space = np.full(1, 32, np.uint8)
    at = np.arange(len(start))  # first words of the features
    crc = _crc_more(np.zeros(len(start), np.uint32), data, start, end, table)
    for width in range(1, hi + 1):
        if width >= lo:
            found.append(crc % np.uint32(buckets))
            of.append(row[at])
        wider = at + width < first[1:][row[at]]
        at, crc = at[wider], crc[wider]
        crc = _crc_more(crc, space, np.zeros(len(at), np.int64), np.ones(len(at), np.int64), table)
        crc = _crc_more(crc, data, start[at + width], end[at + width], table)
    bucket, owner = np.concatenate(found), np.concatenate(of)
    order = np.argsort(owner, kind="stable") if len(found) > 1 else slice(None)
    return bucket[order].astype(np.int32), np.bincount(owner, minlength=n_rows), n_words


def bucketed(docs: DataFrame, widths: tuple[int, int], buckets: int, text_col: str) -> DataFrame:
    """``docs`` without the text, with n_words, n_features and each document's buckets."""
    ship(docs.sparkSession)
    kept = [c for c in docs.columns if c != text_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch[text_col])
            for i, j in runs(offsets, CHUNK):
                found, n, words = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], widths, buckets)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch[c].slice(i, j - i) for c in kept] + [pa.array(words, pa.int64()), pa.array(n, pa.int64()), lists],
                                                 [*kept, "n_words", "n_features", "buckets"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col]
    return docs.mapInArrow(read, ", ".join([*types, "n_words long", "n_features long", "buckets array<int>"]))


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket (the driver gets at most ``buckets`` sums)."""
    out = np.zeros(buckets, np.int64)
    for b, n in table.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count(F.lit(1))).collect():
        out[b] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + B)) / ((s + 1) / (S + B)))) for each of the B buckets."""
    b, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(y) + 1) * (s + b) / ((float(x) + 1) * (t + b)))) for x, y in zip(corpus, target)], np.int64)


def gumbel(seed: int, id_: Column) -> Column:
    """floor(1000 g) of the standard Gumbel variate that the id gives."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, widths: tuple[int, int] = (1, 1), buckets: int = 10_000, seed: int = 2024,
           id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", carry: bool = False) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every document, and with ``carry`` the document itself as ``row``; a stored table."""
    own = [F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")]
    if carry:
        own.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    table = stored(bucketed(docs.select(*own), widths, buckets, "text"), "features")
    aim = bucketed(target.select(text_or_empty(target_text).alias("text")), widths, buckets, "text")
    gains = docs.sparkSession.sparkContext.broadcast(bucket_gains(bucket_counts(table, buckets), bucket_counts(aim, buckets)))

    @F.arrow_udf("long")
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = gains.value
        for b in batches:
            at = b.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[b.flatten().to_numpy(zero_copy_only=False)])])
            yield pa.array(sums[at[1:] - at[0]] - sums[at[:-1] - at[0]], pa.int64())

    rest = ["row"] if carry else []
    return stored(table.select("id", "n_words", "n_features", weight("buckets").alias("weight"), *rest)
                  .withColumn("score", F.col("weight") + gumbel(seed, F.col("id"))), "scores")


def _order(run: bool = True) -> list[Column]:
    """The order of ranks; (run, pos) make keys different."""
    return [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), *([F.asc("run"), F.asc("pos")] if run else [])]


def _numbered(df: DataFrame, number: str, task: str | None = None) -> DataFrame:
    """Rows of each partition counted through in the order in which they come, with the partition's number as ``task``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            more = [pa.array(np.arange(n, n + b.num_rows), pa.int64())] + ([pa.array(np.full(b.num_rows, part), pa.int32())] if task else [])
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, number, *([task] if task else [])])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    return df.mapInArrow(count, ", ".join([*types, f"{number} long", *([f"{task} int"] if task else [])]))


def ranked(candidates: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``candidates`` (id, n_features, score, ...) with rank 1, 2, 3, ... of the first share[0] * N / share[1] rows, null for the others."""
    local = candidates.coalesce(RUNS).sortWithinPartitions(*_order(run=False))
    table = stored(_numbered(local, "pos", "run"), "sorted-runs")
    sizes = {r[0]: r[1] for r in table.groupBy("run").agg(F.count(F.lit(1))).collect()}  # at most RUNS
    total = sum(sizes.values())
    last, empty = share[0] * total // share[1], F.lit(None).cast("long").alias("rank")
    if last == 0:
        return table.drop("run", "pos").select("*", empty)
    # regular samples, each for the same number of rows; as many in all as the square of the runs
    step = max(1, math.ceil(total / len(sizes) ** 2))
    samples = table.where((F.col("pos") + 1) % step == 0).select("score", "id", "n_features", "run", "pos").collect()
    samples.sort(key=lambda r: (-r["score"], r["id"] is None, 0 if r["id"] is None else r["id"], r["n_features"], r["run"], r["pos"]))
    segments = min(len(sizes), len(samples))
    splits = [samples[len(samples) * i // segments] for i in range(1, segments)]
    placed = table.withColumn("segment", _segment(splits, table))
    sizes = {r[0]: r[1] for r in placed.groupBy("segment").agg(F.count(F.lit(1))).collect()}  # at most RUNS
    before, first = {}, 0
    for s in range(segments):
        before[s], first = first, first + sizes.get(s, 0)
    taken = max(s for s in before if before[s] < last and sizes.get(s))
    merged = placed.where(F.col("segment") <= taken).repartitionById(taken + 1, F.col("segment")).sortWithinPartitions(*_order())
    place = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("segment")) + F.col("place") + 1
    own = [c for c in candidates.columns]
    ranks = _numbered(merged, "place").select(*own, F.when(place <= last, place).alias("rank"))
    return ranks.unionByName(placed.where(F.col("segment") > taken).select(*own, empty))


def _segment(splits: list, table: DataFrame) -> Column:
    """The number of splitters whose key is not behind the row's."""
    if not splits:
        return F.lit(0)
    ids = [r["id"] for r in splits]
    others = [np.array([r[c] for r in splits], np.int64) for c in ("n_features", "run", "pos")]
    scores = -np.array([r["score"] for r in splits], np.int64)
    sent = table.sparkSession.sparkContext.broadcast((scores, ids, others))

    def keys(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether ids are null, and their values (integers or strings; those of nulls are alike)."""
        none = ids.is_null().to_numpy(zero_copy_only=False)
        if pa.types.is_integer(ids.type):
            return none, ids.fill_null(0).to_numpy(zero_copy_only=False)
        return none, np.array(["" if x is None else x for x in ids.to_pylist()], object)

    @F.arrow_udf("int")
    def segment(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        scores, ids, others = sent.value
        for b in batches:
            cut = [scores, *keys(pa.array(ids, b[1].type)), *others]
            key = [-b[0].to_numpy(), *keys(b[1]), *[x.to_numpy() for x in b[2:]]]
            lo, hi = np.zeros(len(b[0]), np.int64), np.full(len(b[0]), len(scores), np.int64)
            while (lo < hi).any():  # a binary search of all rows at once
                mid = np.minimum((lo + hi) // 2, len(scores) - 1)
                behind, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
                for c, x in zip(cut, key):
                    behind |= same & (c[mid] > x)
                    same &= c[mid] == x
                go = lo < hi
                lo, hi = np.where(go & ~behind, mid + 1, lo), np.where(go & behind, mid, hi)
            yield pa.array(lo, pa.int32())

    return segment("score", "id", "n_features", "run", "pos")


def importance(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), min_words: int = 20, **how) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; the drawn ones have a rank."""
    table = scored(docs, target, **how)
    own = [c for c in table.columns if c != "n_words"]
    few = table.where(F.col("n_words") < min_words).select(*own, F.lit(None).cast("long").alias("rank"))
    return ranked(table.where(F.col("n_words") >= min_words).select(*own), share).unionByName(few)


def draw(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), min_words: int = 20, **how) -> DataFrame:
    """The drawn documents as they came, with their weight and rank."""
    weight, rank = fresh(docs, "weight", "rank")
    drawn = importance(docs, target, share, min_words, carry=True, **how).where("rank IS NOT NULL")
    return drawn.select("row.*", F.col("weight").alias(weight), F.col("rank").alias(rank))


#: DuckDB: the digest of op13 over the whole tables; crc32 byte by byte, once for each different word.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
word AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
tab AS (
  SELECT list(crc ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::UBIGINT], list_transform(range(8), lambda k: 0::UBIGINT)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS crc FROM range(256) r(i))),
step AS (
  SELECT word, x, 1 AS k, 4294967295::UBIGINT AS crc FROM word
  UNION ALL
  SELECT word, x, k + 1, xor(t[(xor(crc, ('0x' || x[2 * k - 1:2 * k])::UBIGINT) & 255)::INT + 1], crc >> 8)
  FROM step, tab WHERE 2 * k <= length(x)),
bucket AS (SELECT word, (xor(crc, 4294967295::UBIGINT) % 10000)::INT AS b FROM step WHERE 2 * k > length(x)),
s AS (SELECT b, count(*) AS s FROM dw JOIN bucket USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN bucket USING (word) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (b)),
weight AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (b) GROUP BY doc_id),
score AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id::VARCHAR)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN weight USING (doc_id)),
place AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM score WHERE n_features >= 20)
SELECT score.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END::BIGINT AS rank
FROM score LEFT JOIN place USING (doc_id)
"""
