"""Operator 6 - near-duplicates by circulant MinHash, banding and exact verification.

A document's set is its distinct word shingles.  Signatures take two permutations
of a universe of 2**20 places: the first scatters the shingles, the second is
read at the scattered places shifted by 0, 1, ..., K - 1, so that one table gives
all K coordinates.  Bands of R coordinates are the bucket keys.

Texts with equal sets are one class before anything is paired.  Within a bucket no
pairs are enumerated: each class is compared, on full sets, with one pivot, the
class that shares the most buckets with others.  What a pivot leaves open is
settled from the differences to it: for A and B of one pivot P the symmetric
difference of A and B is |A^P| + |B^P| - 2 |(A^P) & (B^P)|, so each A's short
difference to P stands for A, and classes that do not link to P are compared with
each other and with the rest of P's classes in blocks of bounded size, as sparse
vectors.  Classes that link to P need no comparison among themselves, so blocks of
them alone are not dealt.  A block decides every pair and gives out a spanning forest
of its links, at most one link a class.  Every two classes that share a bucket are so
decided exactly, and no large group meets in one task.

Links form components (``components``); the least document id of a component names it.

Defined cases: null, empty and white-space texts have an empty set, link with
nothing and name themselves; fewer words than a shingle make one shingle of all of
them; repeated rows and repeated ids keep all their rows; rows with a null id take
part, and their component's name is null only if no member has an id; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import hashing
from ._common import fresh, runs, stored, utf8
from .components import components

#: Bands and rows: a pair of similarity 0.85 misses all bands with probability 1e-5, one of 0.8 with 4e-4.
BANDS, ROWS = 20, 5
UNIVERSE_BITS = 20
#: Classes in a block of the comparison within a pivot's group.
BLOCK = 512

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = hashing.lower_ascii()
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def permutations(k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(first permutation, windows of the second): row p of the windows has the second at p, p + 1, ..., p + k - 1."""
    if k not in _tables:
        rng, size = np.random.default_rng(seed), 1 << UNIVERSE_BITS
        first = rng.permutation(size).astype(np.int32)
        second = rng.permutation(size).astype(np.uint32)
        ring = np.concatenate([second, second[:k - 1]])  # circular
        _tables[k] = first, np.lib.stride_tricks.sliding_window_view(ring, k)
    return _tables[k]


def signature(shingles: np.ndarray, k: int) -> np.ndarray:
    """The K coordinates of a non-empty set of 64-bit shingle hashes."""
    first, windows = permutations(k)
    place = first[shingles & np.uint64((1 << UNIVERSE_BITS) - 1)]
    out = np.full(k, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(place), 2048):
        np.minimum(out, windows[place[i:i + 2048]].min(0), out=out)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes (64 bits)."""
    for i, j in runs(offsets, 1 << 21):
        h, at = hashing.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], _WORD, _LOWER)
        g = h.copy()
        with np.errstate(over="ignore"):
            for s in range(1, width):
                g[:-s or None] = hashing.mix(g[:-s or None] * np.uint64(0x2545F4914F6CDD1D) + h[s:])
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            n = hi - lo
            if n >= width:
                yield np.unique(g[lo:hi - width + 1])
            elif n:  # a short text is one shingle, told apart by its length
                x = h[lo]
                for y in h[lo + 1:hi]:
                    x = hashing.mix(np.array([x]) * np.uint64(0x2545F4914F6CDD1D) + y)[0]
                yield hashing.mix(np.array([x ^ np.uint64(n)]))
            else:
                yield h[:0]


def with_signatures(docs: DataFrame, width: int, bands: int, rows: int, text_col: str, out: str) -> DataFrame:
    """``docs`` and a struct: n (set size), digest (128 bits of the set; null if empty), bands (bucket keys)."""
    k = bands * rows
    kind = pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf("n long, digest binary, bands array<long>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        salt = hashing.mix(np.arange(1, bands + 1, dtype=np.uint64))
        for b in batches:
            got = []
            for s in shingle_sets(*utf8(b), width):
                if not len(s):
                    got.append({"n": 0, "digest": None, "bands": None})
                    continue
                key = salt.copy()
                with np.errstate(over="ignore"):
                    for col in signature(s, k).reshape(bands, rows).T:
                        key = hashing.mix(key * np.uint64(0x2545F4914F6CDD1D) + col)
                got.append({"n": len(s), "digest": hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "bands": key.view(np.int64)})
            yield pa.array(got, kind)

    return docs.withColumn(out, sign(F.col(text_col)))


def with_sets(docs: DataFrame, width: int, text_col: str, out: str) -> DataFrame:
    """``docs`` and each text's full set of shingle hashes, as array<long>."""

    @F.arrow_udf("array<long>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([s.view(np.int64) for s in shingle_sets(*utf8(b), width)], pa.list_(pa.int64()))

    return docs.withColumn(out, sets(F.col(text_col)))


def _linked(common, na, nb, percent):
    return 100 * common >= percent * (na + nb - common)


def forest(ok: np.ndarray, within: bool, joined: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links ``ok`` (rows x columns; one list of members if ``within``).

    Members ``joined`` (rows, then columns unless ``within``) are linked to each other already.
    """
    n, m = ok.shape
    if within:
        near = ok | ok.T
        neighbours = lambda x: near[x]
    else:
        none_a, none_b = np.zeros(n, bool), np.zeros(m, bool)
        neighbours = lambda x: np.concatenate([none_a, ok[x]]) if x < n else np.concatenate([ok[:, x - n], none_b])
    seen, out = joined.copy(), []
    todo = np.flatnonzero(joined).tolist()
    start = 0
    while True:
        while todo:
            x = todo.pop()
            new = np.flatnonzero(neighbours(x) & ~seen)
            seen[new] = True
            out += [(x, y) for y in new.tolist()]
            todo += new.tolist()
        while start < len(seen) and seen[start]:
            start += 1
        if start == len(seen):
            break
        seen[start] = True
        todo.append(start)
    return out if within else [(min(x, y), max(x, y) - n) for x, y in out]


def links_in_block(a: list[np.ndarray], b: list[np.ndarray] | None, size_a: np.ndarray, size_b: np.ndarray,
                   open_a: np.ndarray, open_b: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two lists of differences to one pivot (b None: within a).

    Members that are not open are linked to the pivot, and so to each other.
    """
    left, right = a, a if b is None else b
    da, db = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    n, both = len(left), left if b is None else [*left, *right]
    flat = np.concatenate(both)
    owner = np.repeat(np.arange(len(both), dtype=np.int32), [len(x) for x in both])
    shared = np.zeros((n, len(right)), np.float32)
    # about half a million shingles at a time, by their low bits
    parts = 1 << (len(flat) >> 19).bit_length()
    low = (flat & (parts - 1)).astype(np.uint16)
    step = 1024
    for part in range(parts):
        at = np.flatnonzero(low == part)
        _, where, count = np.unique(flat[at], return_inverse=True, return_counts=True)
        met = count > 1  # what only one member has is shared with nobody
        col, some = (np.cumsum(met) - 1)[where], met[where]
        col, row = col[some], owner[at][some]
        for lo in range(0, int(met.sum()), step):  # dense columns, a bounded number at a time
            here = (col >= lo) & (col < lo + step)
            m = np.zeros((len(both), step), np.float32)
            m[row[here], col[here] - lo] = 1
            shared += m[:n] @ (m if b is None else m[n:]).T
    apart = da[:, None] + db[None] - 2 * shared
    common = (size_a[:, None] + size_b[None] - apart) / 2
    ok = _linked(common, size_a[:, None], size_b[None], percent) & (open_a[:, None] | open_b[None])
    if b is None:
        np.fill_diagonal(ok, False)
    return forest(ok, b is None, ~open_a if b is None else ~np.concatenate([open_a, open_b]))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, text_key, n_shingles, digest, component (its least class digest), component_id."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t"))
    signed = stored(with_signatures(base, width, bands, rows, "t", "s")
                    .select("id", "text_key", F.col("s.n").alias("n"), F.col("s.digest").alias("digest"), F.col("s.bands").alias("bands")),
                    "signatures")
    # classes of equal sets; one row of each stands for it
    classes = stored(signed.where("digest IS NOT NULL").groupBy("digest")
                     .agg(F.min("id").alias("least_id"), F.min(F.struct("id", "text_key")).alias("row"), F.first("n").alias("n"),
                          F.first("bands").alias("bands")), "classes")
    member = classes.select("digest", F.explode("bands").alias("bucket"))
    large = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    member = stored(member.join(large, "bucket"), "members")
    weight = member.groupBy("digest").agg(F.sum("size").alias("weight"))
    member = member.join(weight, "digest")
    pivot = member.groupBy("bucket").agg(F.max_by("digest", F.struct("weight", "digest")).alias("pivot"))
    star = stored(member.join(pivot, "bucket").where("digest <> pivot").select("pivot", "digest").distinct(), "star")

    # full sets of the classes that share a bucket, from the text of one row each
    needed = star.select("digest").union(star.select("pivot")).distinct().join(classes, "digest").select("digest", "row", "n")
    rows_of = (base.join(needed, base.id.eqNullSafe(needed.row.id) & (base.text_key == needed.row.text_key))
               .select("digest", "n", "t").dropDuplicates(["digest"]))
    sets = stored(with_sets(rows_of, width, "t", "elems").select("digest", "n", "elems"), "sets")
    own = sets.select("digest", F.col("n").alias("n"), F.col("elems").alias("e"))
    other = sets.select(F.col("digest").alias("pivot"), F.col("n").alias("pn"), F.col("elems").alias("pe"))
    against = star.join(own, "digest").join(other, "pivot")
    judged = stored(against.withColumn("common", F.size(F.array_intersect("e", "pe")))
                    .select("pivot", "digest", "n", "pn", "common", _linked(F.col("common"), F.col("n"), F.col("pn"), percent).alias("linked")), "judged")

    # groups where a pivot left something open: at least two members, one of them not linked to it
    group = (judged.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"), F.count_if(~F.col("linked")).alias("open"))
             .where("members > 1 AND open > 0"))
    # open members have blocks of their own, before those of the others; blocks of others alone are not dealt
    n_open, n_other = (F.ceil(c / BLOCK).cast("int") for c in (F.col("open"), F.col("members") - F.col("open")))
    todo = judged.join(group, "pivot").withColumn("open_blocks", n_open).withColumn("other_blocks", n_other)
    apart = (todo.select("pivot", "digest", "linked", "open_blocks", "other_blocks").join(own, "digest").join(other, "pivot")
             .select("pivot", "digest", "n", "linked", "open_blocks", "other_blocks",
                     F.concat(F.array_except("e", "pe"), F.array_except("pe", "e")).alias("apart")))
    hashed = lambda n: F.pmod(F.xxhash64("digest"), F.greatest(F.col(n), F.lit(1))).cast("int")
    block = F.when(F.col("linked"), F.col("open_blocks") + hashed("other_blocks")).otherwise(hashed("open_blocks"))
    dealt = (apart.withColumn("own", block)
             .withColumn("with", F.explode(F.expr("sequence(0, open_blocks - 1 + if(linked, 0, other_blocks))")))
             .withColumn("lo", F.least("own", "with")).withColumn("hi", F.greatest("own", "with")))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        lo, hi = key[1].as_py(), key[2].as_py()
        own_block = table["own"].to_numpy()
        size, open_ = table["n"].to_numpy(), ~table["linked"].to_numpy(zero_copy_only=False)
        diff = table["apart"].combine_chunks()
        elems = np.split(diff.flatten().to_numpy(), np.cumsum(pc.list_value_length(diff).to_numpy())[:-1])
        names = table["digest"].combine_chunks()
        i = np.flatnonzero(own_block == lo)
        j = np.flatnonzero(own_block == hi)
        pick = lambda x: [elems[k] for k in x]
        if lo == hi:
            found = links_in_block(pick(i), None, size[i], size[i], open_[i], open_[i], percent)
        elif len(i) and len(j):
            found = links_in_block(pick(i), pick(j), size[i], size[j], open_[i], open_[j], percent)
        else:
            found = []
        return pa.table({"a": names.take(pa.array([i[x] for x, _ in found], pa.int64())),
                         "b": names.take(pa.array([j[y] for _, y in found], pa.int64()))})

    # dealt by block: the join's partitioning by pivot would do for the grouping, with a hot pivot's blocks all in one task
    more = dealt.repartition("pivot", "lo", "hi").groupBy("pivot", "lo", "hi").applyInArrow(compare, "a binary, b binary")
    edges = judged.where("linked").select(F.col("pivot").alias("a"), F.col("digest").alias("b")).union(more)
    roots = components(edges)
    named = (classes.join(roots, classes.digest == roots.node, "left")
             .select("digest", "least_id", F.coalesce("root", "digest").alias("component")))
    name = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = stored(named.join(name, "component").select("digest", "component", "component_id"), "named")
    return (signed.join(of_class, "digest", "left")
            .select(F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"), "digest", "component",
                    F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """``docs`` with one document of each component: the least id (then the least text key).

    Rows that agree in id and text are one document.  Texts without words all stay.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    row = fresh(docs, "row")[0]
    keep = (found.groupBy("component", F.when(F.col("digest").isNull(), F.struct(id_col, "text_key")).alias("alone"))
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_key").alias("key"))).alias("row"))
            .select(F.struct("row.id", "row.key").alias(row)))
    # (id, text key) as one column, in which null ids are equal: the join and the dropping of repeats share one exchange and one sort of the texts
    return (docs.withColumn(row, F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key")))
            .join(keep, row, "left_semi").dropDuplicates([row]).select(*docs.columns))
