"""Operator 11 - substring dedup by prefix-partitioned suffix trees over words.

A window is ``min_words`` consecutive words of one document.  A word goes if a window
that covers it starts in a document with a smaller id too; windows are judged on the
input.  A document's suffixes begin at its words, and suffixes that share ``min_words``
words are the leaves below one deep internal node of the corpus's suffix tree.

The tree is never held whole:

1. **Suffixes that can lie below a deep node.**  Documents with the same words are one
   leaf set: only those with the least id go on, the others lose all their windows.  The
   least hash of the ``k``-word pieces in a window (its minimizer) is the same wherever
   the window occurs, and neighbouring windows mostly share it, so about one value in
   every dozen words decides which windows can occur in two documents at all.
2. **Variable-length prefixes.**  A suffix is stored as the hashes of the three blocks
   that its first ``min_words`` words make.  Suffixes are counted by their first block; a
   prefix with more than ``GROUP`` suffixes is lengthened by the next block, and so on.  A
   prefix of full length is a deep node itself: its least id is one aggregate, and its
   members never meet.  Prefixes are dealt into groups of about ``GROUP`` suffixes.
3. **Subtrees.**  One task sorts a group's suffixes and takes the depth that neighbours
   share, which is the subtree with its nodes as intervals; the intervals of full depth
   are the maximal repeats' occurrences, and all their leaves but those of the least id
   are marked.
4. Marks meet by document, and the words that they cover are cut out.

A false repeat needs two windows that differ in one block only, and that block's two
contents to share a 64-bit hash.  Nothing is capped: hot passages end as full prefixes,
hot minimizers (at most ``HOT`` can have more than 1/HOT of all rows) are broadcast.

Defined cases: null and empty texts have no words and stay as they are; a document that
loses nothing keeps its text unchanged; one that loses words gets the kept ones joined by
one space (an empty text if none is left); documents with one id do not repeat each
other; a null id comes after all others; equal rows come out as often as they came in;
other columns are kept; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._common import fresh, runs, same_document, stored, text_or_empty, utf8
from .hashing import mix, words

MIN_WORDS = 50
#: Suffixes of a group that a task sorts, and of the longest prefixes a driver's list can name.
GROUP, MOST_PREFIXES = 250_000, 200_000
#: Minimizers that are broadcast instead of joined: those with more than 1/HOT of all rows.
HOT = 1_000
#: Blocks of a suffix's first words; a prefix is one, two or three of them.
BLOCKS = ["b0", "b1", "b2"]
#: Bytes of text that the numpy kernel takes at once.
CHUNK = 1 << 22
#: Base of the pieces' hashes modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _word_bytes() -> np.ndarray:
    b = np.ones(256, bool)
    b[[9, 10, 11, 12, 13, 32]] = False
    return b


class Pieces:
    """Hashes of runs of words in a batch of texts; text t has words first[t] to first[t + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        word, self.first = words(data, offsets, _word_bytes())
        self.n = len(word)
        power = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.n, b, np.uint64)]), dtype=np.uint64)
        self.inverse = power(INVERSE)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * power(BASE)[:self.n], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, n: int) -> np.ndarray:
        """Of the ``n`` words from each position (64 bits, mixed)."""
        return mix((self.sums[start + n] - self.sums[start]) * self.inverse[start])

    def windows(self, n: int) -> np.ndarray:
        """First words of all windows of ``n`` words."""
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.arange(self.n)
        return at[at + n <= self.first[1:][text]]

    def minimizers(self, start: np.ndarray, n: int) -> np.ndarray:
        """The least hash among the pieces of k words in each of the windows of ``n`` words."""
        k = piece_words(n)
        if not len(start):
            return np.zeros(0, np.uint64)
        least, width, need = self.hashes(np.arange(self.n - k + 1), k), 1, n - k + 1
        while 2 * width <= need:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        return np.minimum(least[start], least[start + need - width])


def piece_words(n: int) -> int:
    """Words of a piece in windows of ``n`` words."""
    return max(1, 2 * n // 5)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Pieces]]:
    for batch in batches:
        data, offsets = utf8(batch["text"])
        for i, j in runs(offsets, CHUNK):
            yield batch.slice(i, j - i), Pieces(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def heads(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n_words, digest of the words, its windows' different minimizers) of every row; ``key`` is the text's hash."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pieces in _rows(batches):
            start = pieces.windows(min_words)
            least = pieces.minimizers(start, min_words)
            text = np.searchsorted(pieces.first, start, "right") - 1
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
            text, least = text[new], least[new]
            order = np.lexsort((least, text))
            text, least = text[order], least[order]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
            text, least = text[new], least[new]
            n = np.bincount(text, minlength=batch.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(least.view(np.int64)))
            digest = [sha256(b" ".join(t.encode().split())).digest() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["key"], pa.array(np.diff(pieces.first), pa.int64()), pa.array(digest, pa.binary()), lists],
                                             ["id", "key", "n_words", "digest", "minimizers"])

    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), text_or_empty(text_col).alias("text"))
    return own.mapInArrow(read, f"id {kind}, key long, n_words long, digest binary, minimizers array<long>")


def _same(a: str, b: str, key_a: str, key_b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col(key_a) == F.col(key_b))


def shared_minimizers(of: DataFrame) -> DataFrame:
    """(id, key, values): documents and those of their minimizers that another document has too."""
    each = of.select("id", "key", F.explode("minimizers").alias("m"))
    counts = stored(each.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-minimizers")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.where(F.col("n") > max(total / HOT, 10_000)).select("m").collect()]  # fewer than HOT
    common = F.col("m").isin(hot) if hot else F.lit(False)
    met = each.where(~common).join(counts.where(~common).select("m"), "m").select("id", "key", "m").union(each.where(common))
    return met.groupBy("id", "key").agg(F.collect_list("m").alias("values"))  # of one document


def suffixes(docs: DataFrame, values: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, pos, b0, b1, b2): suffixes whose window has one of its document's ``values`` as minimizer."""
    kind = docs.schema[id_col].dataType.simpleString()
    cut = [min_words * i // len(BLOCKS) for i in range(len(BLOCKS) + 1)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pieces in _rows(batches):
            start = pieces.windows(min_words)
            least = pieces.minimizers(start, min_words).view(np.int64)
            text = np.searchsorted(pieces.first, start, "right") - 1
            lo = np.searchsorted(text, np.arange(batch.num_rows + 1))
            values = batch["values"]
            some = [np.flatnonzero(np.isin(least[lo[t]:lo[t + 1]], values[t].values.to_numpy())) + lo[t] for t in range(batch.num_rows)]
            some = np.concatenate(some) if some else np.zeros(0, np.int64)
            start, text = start[some], text[some]
            for i in range(0, len(start), 1 << 17):
                at, of = start[i:i + (1 << 17)], text[i:i + (1 << 17)]
                blocks = [pa.array(pieces.hashes(at + a, b - a).view(np.int64)) for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(of)), batch["key"].take(pa.array(of)),
                                                  pa.array(at - pieces.first[of], pa.int32()), *blocks], ["id", "key", "pos", *BLOCKS])

    # equal rows are one document
    own = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
           .where("text IS NOT NULL").dropDuplicates(["id", "key"]))
    wanted = values.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "values")
    met = own.join(wanted, _same("id", "_id", "key", "_key")).select("id", "key", "text", "values")
    return met.mapInArrow(read, f"id {kind}, key long, pos int, " + ", ".join(f"{b} long" for b in BLOCKS))


def subtree(blocks: list[pa.Array], ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(order, depth): the group's suffixes sorted by blocks and id, and the blocks that each shares with the one before it.

    This is the suffix tree of the group: its internal nodes are the intervals of ``order`` whose inner depths
    are at least the node's own.
    """
    table = pa.table([*blocks, ids], [*BLOCKS, "id"])
    order = pc.sort_indices(table, [(b, "ascending") for b in [*BLOCKS, "id"]], null_placement="at_end").to_numpy()
    depth, same = np.zeros(len(order), np.int8), np.ones(max(len(order) - 1, 0), bool)
    for b in blocks:
        b = b.to_numpy()[order]
        same &= b[1:] == b[:-1]
        depth[1:] += same
    return order, depth


def later_leaves(blocks: list[pa.Array], ids: pa.Array) -> np.ndarray:
    """Positions of the leaves below deep nodes whose id is not the node's least."""
    order, depth = subtree(blocks, ids)
    if not len(order):
        return order
    code = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[order]
    node = np.cumsum(depth < len(blocks)) - 1
    least = code[np.flatnonzero(depth < len(blocks))][node]
    return order[code != least]


def repeated_suffixes(table: DataFrame) -> DataFrame:
    """(id, key, pos) of the suffixes that share all blocks with a suffix of a smaller id."""
    total = table.count()
    group = max(GROUP, math.ceil(total / MOST_PREFIXES))  # so that a level has at most MOST_PREFIXES longer prefixes
    n_groups = max(1, math.ceil(2 * total / group))
    rest, dealt = table, []
    for level in range(1, len(BLOCKS) + 1):
        prefix = F.xxhash64(*BLOCKS[:level])
        large = stored(rest.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("prefix"), "prefixes")
        if large.isEmpty():
            dealt.append(rest.withColumn("group", F.pmod(prefix, F.lit(n_groups))))
            rest = None
            break
        at = rest.withColumn("prefix", prefix)
        dealt.append(at.join(F.broadcast(large), "prefix", "left_anti").withColumn("group", F.pmod("prefix", F.lit(n_groups))).drop("prefix"))
        rest = at.join(F.broadcast(large), "prefix", "left_semi").drop("prefix")
    light = dealt[0]
    for more in dealt[1:]:
        light = light.unionByName(more)
    kind = table.schema["id"].dataType.simpleString()

    def trees(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        one = lambda c: t[c].chunk(0) if t[c].num_chunks else t[c].combine_chunks()
        return t.select(["id", "key", "pos"]).take(pa.array(later_leaves([one(b) for b in BLOCKS], one("id"))))

    found = light.groupBy("group").applyInArrow(trees, f"id {kind}, key long, pos int")
    if rest is not None:  # full prefixes: at most MOST_PREFIXES, each a node
        least = F.broadcast(stored(rest.groupBy(*BLOCKS).agg(F.min("id").alias("least")), "full-prefixes"))
        found = found.unionByName(rest.join(least, BLOCKS).where("least IS NOT NULL AND (id IS NULL OR id > least)").select("id", "key", "pos"))
    return found


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, starts): for each document with repeats, the first words of windows that a smaller id has too.

    ``starts`` is null where all of its words go, as a document with a smaller id consists of the same ones.
    """
    head = stored(heads(docs, min_words, id_col, text_col), "heads")
    long = head.where(F.col("n_words") >= min_words)
    least = long.groupBy("digest").agg(F.min("id").alias("_id")).withColumnRenamed("digest", "_digest")
    # (digest, least id) is a key that copies do not share
    own = F.col("digest").eqNullSafe(F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id"))
    first = long.select("id", "key", "digest", "minimizers").dropDuplicates(["id", "key"]).join(least, own, "left_semi").select("id", "key", "minimizers")
    copies = long.select("id", "key", "digest").distinct().join(least, own, "left_anti").select("id", "key", F.lit(None).cast("array<int>").alias("starts"))
    table = stored(suffixes(docs, shared_minimizers(first), min_words, id_col, text_col), "suffixes")
    found = repeated_suffixes(table).groupBy("id", "key").agg(F.collect_list("pos").alias("starts"))  # of one document
    return found.unionByName(copies)


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated words, and how many words each had (``n_words``) and lost (``n_removed``).

    The two counts take other names (``_n_words``, ...) where the input has these.
    """
    if min_words < len(BLOCKS):
        raise ValueError(f"windows have at least {len(BLOCKS)} words")
    id_, key, starts = fresh(docs, "id", "key", "starts")
    names = docs.columns
    has = {c.lower() for c in names}
    n_words, n_removed = [c if c not in has else fresh(docs, c)[0] for c in ("n_words", "n_removed")]
    gone = stored(repeats(docs, min_words, id_col, text_col), "repeats")
    gone = gone.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("starts").alias(starts), F.lit(True).alias("hit"))
    hit = fresh(docs, "hit")[0]
    # never a broadcast: repeats grow with the documents
    met = docs.join(gone.withColumnRenamed("hit", hit).hint("merge"), same_document(id_col, text_col, id_, key), "left").drop(id_, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, all_starts, hits = batch[text_col].to_pylist(), batch[starts], batch[hit].to_pylist()
            kept, n, lost = [], [], []
            for i, text in enumerate(texts):
                own = (text or "").encode().split()
                n.append(len(own))
                if not hits[i]:
                    kept.append(text)
                    lost.append(0)
                    continue
                edges = np.zeros(len(own) + 1, np.int64)
                at = all_starts[i].values.to_numpy() if all_starts[i].is_valid else np.arange(len(own) - min_words + 1)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + min_words, -1)
                stays = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
                kept.append(b" ".join([own[k] for k in stays]).decode())
                lost.append(len(own) - len(stays))
            columns = [pa.array(kept, pa.string()) if c == text_col else batch[c] for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(lost, pa.int64())], [*names, n_words, n_removed])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return met.mapInArrow(cut, ", ".join([*types, f"`{n_words}` long, `{n_removed}` long"]))


#: DuckDB: the digest of op11 over the whole tables.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
hit AS (SELECT doc_id, i FROM p JOIN (SELECT h, min(doc_id) AS least FROM p GROUP BY h) USING (h) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM hit),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
