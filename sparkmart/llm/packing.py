"""Operator 2 - best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens.  Lengths are integers up
to the capacity, so the whole packing instance is the count of pieces of each
length: ``capacity`` numbers, however many documents there are.  The plan is made
on these counts.  The reduction procedure fixes small sets of lengths that
dominate every other set with the same longest piece (an exact complement, or the
one or two longest partners where no more fit), with their multiplicities; what
is left is packed best-fit, longest first, over classes of equally full
sequences.  The plan is a short table of rank intervals per length; Spark ranks
the pieces within their length (in hashed buckets, so that a length that holds a
third of all pieces is split) and looks each one's place up.

Defined cases: null text is an empty document (one piece, the end id alone); an
empty table gives no pieces; null and repeated ids keep all their rows; ties are
ranked by (id, piece, content), and pieces equal in all three are alike; other
columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from . import hashing
from ._common import runs, stored, text_or_empty, utf8

# ---------------------------------------------------------------- tokens

#: Pieces that a Python worker keeps the ids of: how many, ids of all of them, and bytes of each at most.
HELD, HELD_IDS, LONG = 1_000_000, 8_000_000, 64
#: Bytes of text that are looked up at a time.
RUN = 1 << 20

#: Kinds of bytes: white space that only separates, letters, marks, others.
_SPACE, _LETTERS, _MARKS, _OTHER = 0, 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 0x0A]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTERS
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = _MARKS


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bytes in lower case, kinds, first bytes, ends) of the runs that can be encoded each on its own.

    White space only separates pieces in the tokenizer, and normalisation never works
    across it, so what stands between spaces or line ends is encoded on its own.  Where
    that holds nothing but Latin letters and ASCII marks (no apostrophe, no start of a
    special token), its pieces are the runs of letters and the runs of marks.
    """
    data = data.copy()
    kind = _KIND[data]
    nxt = np.append(data[1:], 0).astype(np.uint8)
    wide = np.flatnonzero((data == 0xC3) & (nxt >= 0x80) & (nxt != 0x97) & (nxt != 0xB7))  # the Latin-1 letters
    kind[wide] = kind[wide + 1] = _LETTERS
    kind[(data == 0x3C) & (nxt == 0x7C)] = _OTHER  # "<|"
    first, last = hashing.run_bounds((kind != _SPACE).view(np.uint8), offsets)
    others = np.concatenate([[0], np.cumsum(kind == _OTHER, dtype=np.int32)])
    odd = others[last] > others[first]
    fill = np.zeros(len(data) + 1, np.int8)
    fill[first[odd]] += 1
    fill[last[odd]] -= 1
    kind[np.cumsum(fill[:-1], dtype=np.int8) > 0] = _OTHER  # encoded in one, as it stands
    plain = kind == _LETTERS
    data[plain & (data >= 0x41) & (data <= 0x5A)] += 32
    upper = wide[plain[wide] & (data[wide + 1] <= 0x9E)] + 1
    data[upper] += 32
    start, end = hashing.run_bounds(kind, offsets)
    return data, kind[start], start, end


class WordIds:
    """Texts' ids, put together from the ids of their ``word_pieces``.

    All ids come from the tokenizer.  Those of a bounded number of short pieces are kept (by
    their 64-bit hash; 32 MB of ids); the rest is encoded again when it comes, as a text
    without spaces may be one long piece.
    """

    def __init__(self, model: bytes, end_id: int):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model.decode())
        n = self.tok.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.tok.id_to_token(i) or "").endswith("</w>") for i in range(n)], bool)
        self.slot: dict[int, int] = {}  # of a piece's hash; slot 0 is the end of a document
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, "<u4")
        self.flat[0], self.length[0] = end_id, 1
        self.slots = self.ids = 1

    def encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: list[str], single: list[bool]) -> list[bytes]:
        """Ids of pieces; those that are a single piece go many to a call, and the last id of each ends a word."""
        out = [b"" if one else self.encode(p) for p, one in zip(pieces, single)]
        todo = [i for i, one in enumerate(single) if one]
        for k in range(0, len(todo), 256):
            part = todo[k:k + 256]
            ids = np.array(self.tok.encode(" ".join([pieces[i] for i in part]), add_special_tokens=False).ids, "<u4")
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) != len(part):  # not one piece each after all
                for i in part:
                    out[i] = self.encode(pieces[i])
                continue
            raw, at = ids.tobytes(), 0
            for i, e in zip(part, (4 * end).tolist()):
                out[i] = raw[at:e]
                at = e
        return out

    def put(self, ids: list[bytes]) -> None:
        """Append slots."""
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        add = int(length.sum())
        while self.slots + len(ids) > len(self.length):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.ids + add > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        to = slice(self.slots, self.slots + len(ids))
        self.length[to] = length
        self.start[to] = self.ids + np.cumsum(length) - length
        self.flat[self.ids:self.ids + add] = np.frombuffer(b"".join(ids), "<u4")
        self.slots += len(ids)
        self.ids += add

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, each row closed by the end id, and the rows' offsets among them (n + 1)."""
        data, kind, first, end = word_pieces(data, offsets)
        at = np.searchsorted(first, offsets)
        seen, one, which = np.unique(hashing.mix(hashing.run_hashes(data, first, end)), return_index=True, return_inverse=True)
        slot = np.array(list(map(self.slot.get, seen.tolist(), repeat(-1))), np.int64)
        missing = np.flatnonzero(slot < 0)
        missing = missing[np.argsort((end - first)[one[missing]] > LONG, kind="stable")]  # short ones first
        short = int(((end - first)[one[missing]] <= LONG).sum())
        slots, kept = self.slots, self.ids
        for part, keep in ((missing[:short], True), (missing[short:], False)):
            if not len(part):
                continue
            raw, to, new = data.tobytes(), one[part], self.slots
            text = [raw[s:e].decode() for s, e in zip(first[to].tolist(), end[to].tolist())]
            self.put(self.learn(text, (kind[to] != _OTHER).tolist()))
            slot[part] = np.arange(new, self.slots)
            if keep and self.slots <= HELD and self.ids <= HELD_IDS:
                self.slot.update(zip(seen[part].tolist(), range(new, self.slots)))
                slots, kept = self.slots, self.ids
        rows = len(offsets) - 1
        order = np.zeros(len(which) + rows, np.int64)  # slots, with a document's end after its chunks
        order[np.arange(len(which)) + np.repeat(np.arange(rows), np.diff(at))] = slot[which]
        length = self.length[order]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.repeat(self.start[order] - total[:-1], length) + np.arange(total[-1])]
        self.slots, self.ids = slots, kept  # forget what is over the bounds
        if len(self.flat) > 4 * max(self.ids, 1 << 20):
            self.flat = self.flat[:2 * max(self.ids, 1 << 20)].copy()
        return ids, total[at + np.arange(rows + 1)]


_worker: dict[tuple[int, int], WordIds] = {}


def pieces_of(docs: DataFrame, model: bytes, capacity: int, end_id: int, keep_ids: bool = False,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): documents cut into pieces of ``capacity`` tokens.

    Only documents longer than the capacity are cut.  ``keep_ids`` adds the ids themselves.
    """
    ship(docs.sparkSession)
    key = zlib.crc32(model), end_id
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _worker:
            _worker.clear()
            _worker[key] = WordIds(sent.value, end_id)
        for b in batches:
            data, offsets = utf8(b.column(1))
            for i, j in runs(offsets, RUN):
                ids, at = _worker[key](data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                n = -(-np.diff(at) // capacity)  # at least 1: the end id is there
                row = np.repeat(np.arange(j - i), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                lo = at[row] + piece * capacity
                hi = np.minimum(lo + capacity, at[row + 1])
                cols = [b.column(0).take(pa.array(row + i)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()),
                        pa.array(hi - lo, pa.int64()), pa.array([zlib.crc32(ids[x:y]) for x, y in zip(lo, hi)], pa.int64())]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(ids)), pa.int32()), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"`{id_col}` {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col), text_or_empty(text_col)).mapInArrow(cut, schema + ", ids array<int>" * keep_ids)


# ---------------------------------------------------------------- the plan

#: (how many sequences, [(length, pieces of that length in each)])
Pattern = tuple[int, list[tuple[int, int]]]


class _Counts:
    """Pieces left of each length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = [0] * (capacity + 1)
        for size, k in counts.items():
            self.n[size] += k

    def without(self, *sizes: int) -> None:
        for s in sizes:
            self.n[s] -= 1

    def back(self, *sizes: int) -> None:
        for s in sizes:
            self.n[s] += 1

    def largest(self, room: int) -> int:
        """The largest length that fits ``room``; 0 if none does."""
        n = self.n
        for s in range(room, 0, -1):
            if n[s] > 0:
                return s
        return 0

    def smallest(self, k: int, above: int = 0) -> list[int]:
        out: list[int] = []
        for s in range(above + 1, len(self.n)):
            if self.n[s] > 0:
                out += [s] * min(self.n[s], k - len(out))
                if len(out) == k:
                    break
        return out

    def best_pair(self, room: int) -> int:
        """The largest sum of two pieces that fit ``room`` together; 0 if no two do."""
        n, best, hi = self.n, 0, room
        for lo in range(1, room):
            if n[lo] <= 0:
                continue
            hi = min(hi, room - lo)
            while hi > lo and n[hi] <= 0:
                hi -= 1
            if hi < lo:
                break
            if hi > lo or n[lo] > 1:
                best = max(best, lo + hi)
        return best


def dominating_set(c: _Counts, j: int, capacity: int) -> list[int] | None:
    """A set with one piece of length ``j`` that dominates all others with it, or None.

    Each rule stays valid while its lengths last: taking pieces away only leaves fewer rivals.
    """
    c.without(j)
    try:
        room = capacity - j
        a = c.largest(room)
        if not a:
            return [j]
        few = c.smallest(3)
        if a == room or len(few) < 2 or few[0] + few[1] > room:
            return [j, a]  # fills the sequence, or only one more piece fits
        if len(few) == 3 and sum(few) <= room:
            return None
        if a >= c.best_pair(room):  # at most two more fit, and a covers any two of them
            return [j, a]
        c.without(a)
        b = c.largest(room - a)
        c.back(a)
        if b:
            rivals = c.smallest(2, above=b)  # a pair that b does not cover has both pieces longer than b
            if len(rivals) < 2 or sum(rivals) > room:
                return [j, a, b]
        return None
    finally:
        c.back(j)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that some best packing has, and the pieces that are left, by length."""
    c, fixed = _Counts(counts, capacity), []
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while c.n[j] > 0 and (found := dominating_set(c, j, capacity)):
                per = {s: found.count(s) for s in found}
                times = min(c.n[s] // k for s, k in per.items())
                for s, k in per.items():
                    c.n[s] -= times * k
                fixed.append((times, sorted(per.items(), reverse=True)))
                changed = True
    return fixed, {s: k for s, k in enumerate(c.n) if k}


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over classes of equally full sequences."""
    open_: dict[int, list[Pattern]] = {}  # by room left
    for s in sorted(counts, reverse=True):
        left = counts[s]
        for room in sorted(r for r in open_ if r >= s):
            classes = open_.pop(room)
            for i, (times, has) in enumerate(classes):
                most = room // s
                full = min(times, left // most)
                rest = min(left - full * most, most - 1) if full < times else 0
                if full:
                    open_.setdefault(room - most * s, []).append((full, [*has, (s, most)]))
                if rest:
                    open_.setdefault(room - rest * s, []).append((1, [*has, (s, rest)]))
                if same := times - full - bool(rest):
                    open_.setdefault(room, []).append((same, has))
                left -= full * most + rest
            if not left:
                break
        most = capacity // s
        if full := left // most:
            open_.setdefault(capacity - most * s, []).append((full, [(s, most)]))
        if rest := left % most:
            open_.setdefault(capacity - rest * s, []).append((1, [(s, rest)]))
    return [p for room in sorted(open_) for p in open_[room]]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """All sequences, by pattern: what the reduction fixes, and best-fit for the rest."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def intervals(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces in each sequence, offset in it)."""
    out, used, first = [], {}, 0
    for times, has in patterns:
        offset = 0
        for s, k in has:
            lo = used.get(s, 0)
            used[s] = lo + times * k
            out.append((s, lo, used[s], first, k, offset))
            offset += s * k
        first += times
    return out


# ---------------------------------------------------------------- placing

def place(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` (a stored table with ``length``) with sequence_id and offset; ``order`` ranks equal lengths."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = intervals(plan(counts, capacity))
    by_length = (spark.createDataFrame(table, "length long, lo long, hi long, first long, each long, at long")
                 .groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "first", "each", "at"))).alias("_to")))
    buckets = max(1, isqrt(max(counts.values(), default=1)))
    p = pieces.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (p.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n"))
              .drop("_n"))
    ranked = (p.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_b").orderBy(*order)))
              .join(before, ["length", "_b"])
              .withColumn("_r", F.col("_before") + F.col("_r") - 1)
              .join(F.broadcast(by_length), "length")  # bounded by the capacity, not by the data
              .withColumn("_to", F.expr("element_at(filter(_to, x -> x.lo <= _r AND _r < x.hi), 1)"))
              .withColumn("_k", F.col("_r") - F.col("_to.lo")))
    each = F.col("_to.each")
    return (ranked.withColumn("sequence_id", F.col("_to.first") + F.floor(F.col("_k") / each))
            .withColumn("offset", F.col("_to.at") + F.col("_k") % each * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack(docs: DataFrame, model: bytes, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens.

    One row per piece: id, piece, start, length, ids_crc32[, ids], sequence_id, offset.
    """
    pieces = stored(pieces_of(docs, model, capacity, end_id, keep_ids, id_col, text_col), "pieces")
    return place(pieces, capacity, [id_col, "piece", "ids_crc32", "start"])
