"""Operator 1 - exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits is cut into four segments of 16.  If two codes differ in at most
4 (r + 1) - 1 bits, some segment differs in at most r bits (pigeonhole).  So a query
probes the four segment tables at radius 0, 1, 2, ..., verifies every code that it
meets by its full distance, and stops once its k-th best verified distance is at most
4 (r + 1) - 1: everything closer has provably been seen.

Vectors with equal codes are one entry with its k smallest ids (ties go to the smaller
id, so no more can be wanted), found with a bounded ranking.  Entries are dealt in
blocks of bounded size by a hash of the code; every block meets the query codes in
blocks, indexes itself and answers with its own exact top k; the blocks' answers are
merged by a ranking per query.  No candidate leaves its task.

Defined cases: null ids and null vectors are left out (they cannot be named or coded);
a shorter vector is padded with zero bits, a longer one is refused with an error; null components count as 0; repeated rows of
one id and code count once; a query finds itself, at distance 0; fewer than k vectors
give fewer rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from ._common import stored

SEGMENTS, SEGMENT_BITS = 4, 16
#: Codes of an index block and of a query block at most, on average; queries that a task answers at a time.
INDEX_BLOCK, QUERY_BLOCK, AT_ONCE = 1 << 20, 1 << 16, 512

_COUNT = np.array([bin(i).count("1") for i in range(1 << SEGMENT_BITS)], np.uint8)
#: Segment values by their number of bits: what a probe at radius r is xored with.
_FLIPS = [np.flatnonzero(_COUNT == r).astype(np.uint16) for r in range(SEGMENT_BITS + 1)]


def sign_code(vector: str = "embedding") -> Column:
    """A vector's 64 sign bits as a long: bit i is set where component i is positive."""
    code = f"aggregate(sequence(0, 63), 0L, (c, i) -> c | if(coalesce(get({vector}, i), 0) > 0, shiftleft(1L, i), 0L))"
    return F.expr(f"if(size({vector}) > 64, cast(raise_error('a code holds 64 components') AS bigint), {code})")


class SegmentIndex:
    """Segment tables of a block of distinct codes: the codes in order of a segment, and where each value starts."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = codes.view(np.uint16).reshape(-1, SEGMENTS)
        self.order, self.first = [], []
        for s in range(SEGMENTS):
            self.order.append(np.argsort(self.parts[:, s], kind="stable").astype(np.int32))
            self.first.append(np.concatenate([[0], np.cumsum(np.bincount(self.parts[:, s], minlength=1 << SEGMENT_BITS))]))

    def meet(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) of all entries that have a segment at exactly ``radius`` bits; a pair may come twice."""
        parts = queries.view(np.uint16).reshape(-1, SEGMENTS)
        flips, who, found = _FLIPS[radius], [], []
        for s in range(SEGMENTS):
            value = (parts[:, s][:, None] ^ flips[None]).ravel()
            lo = self.first[s][value]
            n = self.first[s][value + np.int64(1)] - lo
            some = np.flatnonzero(n)
            n, lo = n[some], lo[some]
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append(self.order[s][at])
            who.append(np.repeat(some // len(flips), n))
        return np.concatenate(who), np.concatenate(found)

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a ^ b
        return _COUNT[x.view(np.uint16).reshape(-1, SEGMENTS)].sum(1, dtype=np.int32)


def nearest(index: SegmentIndex, counts: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, distance) of the entries that hold each query's ``k`` nearest ids; ``counts``: ids of each entry.

    Grows the radius for the queries whose k-th verified distance is not yet covered.
    """
    out = []
    todo = np.arange(len(queries))
    seen = np.zeros(0, np.int64)  # query * entries + entry, sorted
    dist = np.zeros(0, np.int32)
    size = max(len(index.codes), 1)
    for radius in range(SEGMENT_BITS + 1):
        if not len(todo):
            break
        step = max(1, (1 << 22) // (SEGMENTS * len(_FLIPS[radius])))
        new = []
        for lo in range(0, len(todo), step):
            who, entry = index.meet(queries[todo[lo:lo + step]], radius)
            new.append(np.unique(todo[lo + who] * size + entry))
        new = np.concatenate(new)
        new = new[~np.isin(new, seen, assume_unique=True)]
        d = index.distance(queries[new // size], index.codes[new % size])
        seen, dist = np.concatenate([seen, new]), np.concatenate([dist, d])
        order = np.lexsort((dist, seen // size))
        seen, dist = seen[order], dist[order]
        # ids at most at each place of a query's list, and the distance where there are k of them
        query = seen // size
        ids = counts[seen % size]
        total = np.cumsum(ids)
        start = np.searchsorted(query, todo)
        before = np.concatenate([[0], total])[start]
        place = np.searchsorted(total, before + k)
        end = np.searchsorted(query, todo, side="right")
        full = place < end
        kth = np.where(full, dist[np.minimum(place, max(len(dist) - 1, 0))] if len(dist) else 0, 1 << 20)
        covered = SEGMENTS * (radius + 1) - 1
        done = (kth <= covered) | (radius == SEGMENT_BITS)
        closed = np.zeros(len(queries), bool)
        closed[todo[done]] = True
        limit = np.full(len(queries), 1 << 20)
        limit[todo[done]] = kth[done]
        mine = closed[query]
        keep = mine & (dist <= limit[query])
        out.append((query[keep], seen[keep] % size, dist[keep]))
        seen, dist, todo = seen[~mine], dist[~mine], todo[~done]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*out))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", code_col: str = "code") -> DataFrame:
    """(query_id, rank, neighbor_id, distance): each query's ``k`` nearest ids, ties by id.

    ``codes`` and ``queries`` have an id and a 64-bit code (long); every code is indexed.
    """
    spark = codes.sparkSession
    ship(spark)
    rows = codes.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).where("id IS NOT NULL AND code IS NOT NULL").distinct()
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k)
    entries = stored(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")  # at most k ids each
    asked = stored(queries.select(F.col(id_col).alias("query_id"), F.col(code_col).alias("code"))
                   .where("query_id IS NOT NULL AND code IS NOT NULL").distinct(), "queries")
    wanted = asked.select("code").distinct()
    blocks = max(1, ceil(entries.count() / INDEX_BLOCK))
    # no fewer groups than cores, whatever the sizes
    asks = max(1, ceil(wanted.count() / QUERY_BLOCK), ceil(spark.sparkContext.defaultParallelism / blocks))
    left = (entries.select(F.pmod(F.xxhash64("code"), F.lit(blocks)).alias("block"), "code", F.size("ids").alias("n"))
            .withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(asks - 1)))))
    right = (wanted.select(F.pmod(F.xxhash64("code", F.lit(1)), F.lit(asks)).cast("int").alias("ask"), "code")
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
             .select("block", "code", F.lit(0).alias("n"), "ask"))

    def search(key: tuple, table: pa.Table) -> pa.Table:
        n, code = table["n"].to_numpy(), table["code"].to_numpy().view(np.uint64)
        mine, ask = code[n > 0], code[n == 0]
        index, ids = SegmentIndex(mine), n[n > 0].astype(np.int64)
        found = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for lo in range(0, len(ask) if len(mine) else 0, AT_ONCE):
            part = ask[lo:lo + AT_ONCE]
            q, e, d = nearest(index, ids, part, k)
            for to, x in zip(found, (part[q], mine[e], d.astype(np.int32))):
                to.append(x)
        query, code, distance = map(np.concatenate, found)
        return pa.table({"query": query.view(np.int64), "code": code.view(np.int64), "distance": distance})

    met = left.union(right.select("block", "code", "n", "ask")).groupBy("block", "ask").applyInArrow(search, "query long, code long, distance int")
    by_query = Window.partitionBy("query").orderBy("distance", "id")
    best = (met.join(entries, "code").select("query", "distance", F.explode("ids").alias("id"))
            .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k))
    return (asked.join(best, asked.code == best["query"])
            .select("query_id", "rank", F.col("id").alias("neighbor_id"), "distance"))


#: DuckDB: all distances of the query rows.
ORACLE = """
WITH c AS (SELECT DISTINCT vec_id AS id, list_reduce(list_transform(range(0, 64), lambda i:
               CASE WHEN coalesce(embedding[i + 1], 0) > 0 THEN (1::UBIGINT << i::UBIGINT) ELSE 0::UBIGINT END), lambda a, b: a | b) AS code
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
SELECT query_id, rank::INTEGER AS rank, neighbor_id, distance::INTEGER AS distance FROM (
  SELECT q.id AS query_id, e.id AS neighbor_id, bit_count(xor(q.code, e.code)) AS distance,
         row_number() OVER (PARTITION BY q.id ORDER BY bit_count(xor(q.code, e.code)), e.id) AS rank
  FROM c q, c e WHERE q.id % 50 = 0) WHERE rank <= 10
"""
