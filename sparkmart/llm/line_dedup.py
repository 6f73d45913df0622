"""Operator 10 - line-level deduplication by pairwise alignment.

Documents that share runs of lines are aligned in pairs by patience diff, and the
common blocks are deleted from the later document of the pair (the larger id).

Candidates: from every line of a document, the shortest run of consecutive lines with
at least ``min_words`` words that begins there, and the shortest that ends there, seed
pairs: each document that holds a run is paired with the first one that does, so a run
in a third of all documents makes one pair for each of them and no group is collected.
Every line of a common block lies in such a run within the block, and the run's first
holder has it whole, so a later document loses what it would lose if all pairs of
documents were aligned.  Runs are told apart by 64-bit hashes, as lines are.

Alignment works on the documents' line hashes alone: lines that are unique in both
documents and in increasing order in both (the longest such sequence) anchor it,
each gap between anchors is aligned in the same way, and anchors extend to equal
neighbours.  A block is a run of lines that are next to each other in both
documents; it is deleted if it has at least ``min_words`` words (by white space; in
scripts without spaces letters count as well, see ``n_words``).  Where lines that the
alignment leaves (repeated ones, moved ones) could still make a block, the earlier
document's suffix automaton gives the longest common runs at any positions, in linear
time; so every common block goes, each of its repeats in the later document too.  A
line's first holder never loses it, so nothing disappears from the corpus.

Defined cases: null and empty texts share nothing and stay as they are; rows that
agree in id and text are one document (each comes out as often as it came in); rows
with a null id come after all others, those with equal ids are ordered by a hash of
the text; a document whose every line is deleted gets an empty text (``deduplicate``)
or goes (``drop_emptied``); other columns are kept; an empty table stays empty.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ._common import fresh, same_document, stored

#: Words of a block that is deleted at least.
MIN_WORDS = 25
#: Letters of scripts that are written without spaces: about 2 and about 5 make a word.
IDEOGRAMS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}"
NO_SPACES = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
#: Base of the runs' hashes modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Rows of seeds that leave a task's Python at once.
ROWS = 1 << 17


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: matching positions of equal items, increasing in both lists."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(b[b0:b1], b0) if once_b[x] == 1}
        both = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if once_a[x] == 1 and x in place]
        # the longest increasing sequence, by piles
        tops: list[int] = []
        pile: list[int] = []
        back: list[int] = []
        for k, (_, j) in enumerate(both):
            p = bisect_left(tops, j)
            back.append(pile[p - 1] if p else -1)
            if p == len(tops):
                tops.append(j)
                pile.append(k)
            else:
                tops[p], pile[p] = j, k
        anchors, k = [], pile[-1] if pile else -1
        while k >= 0:
            anchors.append(both[k])
            k = back[k]
        # each anchor is matched at the front of the part that it opens
        ends = [(a1, b1)] + anchors[:-1]
        todo += [(i, e[0], j, e[1]) for (i, j), e in zip(anchors, ends)]
        if anchors:
            todo.append((a0, anchors[-1][0], b0, anchors[-1][1]))
    return sorted(out)


def longest_ends(a: list[int], b: list[int]) -> list[int]:
    """For each position of ``b``, how many items up to it stand somewhere in ``a`` in a row (by ``a``'s suffix automaton)."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for x in a:
        new, p = len(after), last
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and x not in after[p]:
            after[p][x] = new
            p = link[p]
        if p >= 0:
            q = after[p][x]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and after[p].get(x) == q:
                    after[p][x] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    out, state, n = [], 0, 0
    for x in b:
        while state and x not in after[state]:
            state = link[state]
            n = length[state]
        if x in after[state]:
            state, n = after[state][x], n + 1
        out.append(n)
    return out


def blocks(a: list[int], b: list[int], words_b: list[int], min_words: int) -> list[int]:
    """Positions in ``b`` of the common blocks with at least ``min_words`` words, at any two positions."""
    out: set[int] = set()
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*common_lines(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words_b[k] for k in run) >= min_words:
                out.update(run)
            run = []
        run.append(j)
        last = (i, j)
    # the alignment is one increasing sequence of lines that are unique: it leaves out repeated and moved blocks
    has, lo = set(a), 0
    ends = None
    for hi in range(len(b) + 1):
        if hi < len(b) and b[hi] in has:
            continue
        if sum(words_b[lo:hi]) >= min_words and not out.issuperset(range(lo, hi)):
            ends = ends or longest_ends(a, b)
            before = [0, *accumulate(words_b[lo:hi])]
            begin = hi
            for j in range(hi - 1, lo - 1, -1):  # from the right, each position at most once
                start = j + 1 - ends[j]
                if before[j + 1 - lo] - before[start - lo] >= min_words and start < begin:
                    out.update(range(start, min(j + 1, begin)))
                    begin = start
        lo = hi + 1
    return sorted(out)


def _key(id_col: str, text_col: str) -> Column:
    """A document's name, in the order of documents."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))


def n_words(line: Column) -> Column:
    """Words by white space, and in scripts written without spaces one more for each 2 (``IDEOGRAMS``) or 5 (``NO_SPACES``) letters."""
    shown = F.trim(line)
    spaced = F.when(shown == "", 0).otherwise(F.size(F.split(shown, r"\s+")))
    letters = lambda kind: F.length(F.regexp_replace(line, f"[^{kind}]+", ""))
    more = F.floor(letters(IDEOGRAMS) / 2 + letters(NO_SPACES) / 5).cast("int")
    return spaced + F.when(F.octet_length(line) > F.length(line), more).otherwise(0)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, hashes, words): each document's line hashes and their numbers of words; documents with a text only."""
    lines = F.split(F.col(text_col), "\n", -1)
    return (docs.where(F.col(text_col).isNotNull()).select(_key(id_col, text_col).alias("doc"), lines.alias("l"))
            .select("doc", F.transform("l", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("l", n_words).alias("words")))


def run_hashes(hashes: np.ndarray, words: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the shortest runs with ``min_words`` words from and up to each line, once a document.

    The documents' lines follow each other; document d has those from ``offsets[d]`` to ``offsets[d + 1]``.
    """
    n, min_words = len(hashes), max(min_words, 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    line = np.arange(n)
    end = np.searchsorted(before, before[:-1] + min_words, "left")  # the first end that makes a run long enough
    start = np.searchsorted(before, before[1:] - min_words, "right") - 1  # the last such start
    on, up = end <= offsets[1:][doc], start >= offsets[:-1][doc]
    lo, hi = np.concatenate([line[on], start[up]]), np.concatenate([end[on], line[up] + 1])
    power = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.view(np.uint64) * power(BASE)[:n], dtype=np.uint64)])
    run = (total[hi] - total[lo]) * power(INVERSE)[lo] * np.uint64(BASE) + (hi - lo).astype(np.uint64)
    of = np.concatenate([doc[on], doc[up]])
    order = np.lexsort((run, of))
    of, run = of[order], run[order].view(np.int64)
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (run[1:] != run[:-1])
    return of[new], run[new]


def candidate_pairs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(first, later): documents to align."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch["hashes"].offsets.to_numpy()
            of, run = run_hashes(batch["hashes"].flatten().to_numpy(), batch["words"].flatten().to_numpy(), offsets - offsets[0], min_words)
            for i in range(0, len(of), ROWS):
                yield pa.RecordBatch.from_arrays([batch["doc"].take(pa.array(of[i:i + ROWS])), pa.array(run[i:i + ROWS])], ["doc", "run"])

    seed = lines.mapInArrow(seeds, f"doc {lines.schema['doc'].dataType.simpleString()}, run long")
    shared = seed.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).where("n > 1").drop("n")
    return seed.join(shared, "run").where("doc <> first").select("first", F.col("doc").alias("later")).distinct()


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, gone): the positions of the lines that a document loses."""
    ship(docs.sparkSession)
    lines = stored(lines_of(docs, id_col, text_col).dropDuplicates(["doc"]), "lines")
    pairs = candidate_pairs(lines, min_words)
    later = lines.select(F.col("doc").alias("later"), F.col("hashes").alias("b"), "words")
    first = lines.select(F.col("doc").alias("first"), F.col("hashes").alias("a"))
    sides = pairs.join(later, "later").join(first, "first").select("later", "a", "b", "words")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for i in range(batch.num_rows):
                gone.append(blocks(batch["a"][i].as_py(), batch["b"][i].as_py(), batch["words"][i].as_py(), min_words))
            some = [i for i, g in enumerate(gone) if g]
            yield pa.RecordBatch.from_arrays([batch["later"].take(pa.array(some, pa.int64())),
                                              pa.array([gone[i] for i in some], pa.list_(pa.int32()))], ["doc", "gone"])

    kind = lines.schema["doc"].dataType.simpleString()
    found = sides.mapInArrow(align, f"doc {kind}, gone array<int>")
    return (found.groupBy("doc").agg(F.collect_set("gone").alias("g"))  # a document's pairs: at most two for each of its lines
            .select("doc", F.array_distinct(F.flatten("g")).alias("gone")))


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the repeated blocks cut out of the later documents' texts (and ``n_chars`` to match)."""
    gone = stored(deleted_lines(docs, min_words, id_col, text_col), "deleted-lines")
    id_, key, gone_, new = fresh(docs, "id", "key", "gone", "new")
    gone = gone.select(F.col("doc.id").alias(id_), F.col("doc.text").alias(key), F.col("gone").alias(gone_))
    lines, cut = F.split(F.col(text_col), "\n", -1), F.col(gone_).isNotNull()
    # never a broadcast: what is deleted grows with the documents
    out = docs.join(gone.hint("merge"), same_document(id_col, text_col, id_, key), "left")
    if drop_emptied:
        out = out.where(~cut | (F.size(gone_) < F.size(lines)))
    # the lines are split once (x) and their positions told apart by a hash set
    left = F.transform(F.array(lines), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone_)), lambda i: F.get(x, i)))
    kept = F.array_join(F.get(left, F.lit(0)), "\n")
    out = out.withColumn(new, F.when(cut, kept).otherwise(F.col(text_col)))
    length = lambda c: F.when(cut, F.length(new).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    return out.select(*[F.col(new).alias(c) if c == text_col else length(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
