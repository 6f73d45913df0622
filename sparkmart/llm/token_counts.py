"""Operator 7 - token counts by a two-tier lookup on the map side.

A text's pre-tokens are runs of spaces with the word that follows.  No piece of
the vocabulary has a space mark after another character, so merges never cross
a pre-token's front and a text's token count is the sum over its pre-tokens.

Tier 1 is a compact hash table of the frequent pre-tokens' lengths, broadcast to
the tasks.  It comes from all documents: each task counts its own pre-tokens in
bounded memory and passes on only its most frequent ones.  Tier 2 is each
Python worker's own cache, which encodes what the table misses.  Pre-tokens are
never shuffled, and the counts are exact whatever the table holds.

Both tiers hold pre-tokens of at most ``LONG`` bytes: a longer one (a text without
spaces may be one) is encoded when it comes and never counted, sent or kept.  So the
table has at most ``TABLE_SIZE * LONG`` bytes (1 MB) and a worker's cache 25 MB of keys.

Defined cases: null and empty texts have 0 bytes and 0 tokens; one row comes out
for each row that goes in (repeated rows and null ids too); other columns of the
input are neither needed nor read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._common import text_or_empty

#: Entries of the broadcast table, and what a task hands on towards it.
TABLE_SIZE = 16_384
PER_TASK = 2_048
#: Pre-tokens that a task counts, or a worker caches, at the same time, and bytes of each at most.
HELD, LONG = 400_000, 64

_PRE_TOKEN = re.compile(" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, each without the first of its spaces."""
    if not text:
        return []
    text = text.replace("▁", " ")
    parts = text.split(" ")
    if "" in parts:
        return [p[1:] for p in _PRE_TOKEN.findall(" " + text)]
    return parts


def is_short(key: str) -> bool:
    return len(key) <= LONG and (key.isascii() or len(key.encode()) <= LONG)


def frequent_pre_tokens(docs: DataFrame, size: int = TABLE_SIZE, per_task: int = PER_TASK) -> DataFrame:
    """(pre_token, n): the corpus's most frequent short pre-tokens, by bounded counting in each task."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(filter(is_short, pre_tokens(text)))
                if len(seen) > HELD:
                    seen = Counter(dict(heapq.nlargest(HELD // 2, seen.items(), key=lambda x: x[1])))
        top = heapq.nlargest(per_task, seen.items(), key=lambda x: x[1])
        if top:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()),
                                              pa.array([v for _, v in top], pa.int64())], ["pre_token", "n"])

    tops = docs.select(text_or_empty().alias("text")).mapInArrow(count, "pre_token string, n long")
    return (tops.groupBy("pre_token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "pre_token").limit(size))


class _Lengths(dict):
    """Pre-token to token count; encodes what it lacks and keeps a bounded number of them."""

    def __init__(self, table: dict[str, int], model: bytes):
        import sentencepiece

        super().__init__(table)
        self[""] = 1  # a lone space
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode

    def __missing__(self, key: str) -> int:
        n = len(self.encode(key))
        if len(self) < HELD and is_short(key):
            self[key] = n
        return n


#: The lookup of the query that a Python worker serves just now, by that query's key.
_worker: dict[str, _Lengths] = {}


def with_token_counts(docs: DataFrame, model: bytes, table: DataFrame | None = None,
                      column: str = "n_tokens") -> DataFrame:
    """``docs`` and each text's number of tokens under the SentencePiece model ``model`` (the file's bytes)."""
    import sentencepiece

    spark = docs.sparkSession
    ship(spark)
    encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
    rows = (frequent_pre_tokens(docs) if table is None else table).select("pre_token").collect()  # bounded by TABLE_SIZE
    lengths_of = {r[0]: len(encode(r[0])) if r[0] else 1 for r in rows}
    sent, key = spark.sparkContext.broadcast((lengths_of, model)), uuid.uuid4().hex

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _worker:
            _worker.clear()
            _worker[key] = _Lengths(*sent.value)
        get = _worker[key].__getitem__
        for b in batches:
            yield pa.array([sum(map(get, pre_tokens(t))) for t in b.to_pylist()], pa.int64())

    return docs.withColumn(column, n_tokens(text_or_empty()))
