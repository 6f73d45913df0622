import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import packing
from sparkmart.llm._common import utf8
from sparkmart.llm.queries import QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def model():
    return tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(model):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(model.decode())


def test_ids_equal_the_librarys(model, tokenizer):
    rnd, ids_of = random.Random(1), packing.WordIds(model, 0)
    alphabet = " abAÀßÿ'st.,!<|endoftext|>\n\t0#\x00\U0001f600日́ ×"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(6000)]
    texts += [t[:4] + "<|endoftext|>" + t[4:] for t in texts[:1000]] + ["ÀÉ x" * 50, "don't we'll", "x" * 5000]
    for k in range(0, len(texts), 500):
        ids, at = ids_of(*utf8(pa.array(texts[k:k + 500])))
        for n, t in enumerate(texts[k:k + 500]):
            assert ids[at[n]:at[n + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0], repr(t)


def least_bins(sizes, capacity):
    """Exact minimum by branch and bound, for a handful of sizes."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1:]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum_and_plans_are_valid(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 17, 30])
    sizes = [rnd.randint(max(1, capacity // rnd.choice([2, 4, 9])), capacity) for _ in range(rnd.randint(1, 11))]
    counts = {s: sizes.count(s) for s in sizes}
    fixed, rest = packing.reduce_by_dominance(counts, capacity)
    left = list(itertools.chain.from_iterable([s] * k for s, k in rest.items()))
    assert sum(n for n, _ in fixed) + least_bins(left, capacity) == least_bins(sizes, capacity)
    plan = packing.plan(counts, capacity)
    used = {}
    for times, has in plan:
        assert times > 0 and sum(s * k for s, k in has) <= capacity
        for s, k in has:
            used[s] = used.get(s, 0) + times * k
    assert used == counts
    assert sum(n for n, _ in plan) <= 1.3 * least_bins(sizes, capacity) + 1


def test_plan_does_not_grow_with_the_documents():
    rnd = random.Random(4)
    counts = {s: rnd.randint(1, 10**9) for s in range(1, 2049)}
    plan = packing.plan(counts, 2048)
    assert len(plan) < 20_000
    total = sum(s * k for s, k in counts.items())
    assert sum(n for n, _ in plan) < 1.02 * total / 2048


def check(rows, docs, tokenizer, capacity):
    want = []
    for i, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want.append((i, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r[:5]) for r in rows], key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_odd_rows(spark, make, odd, model, tokenizer):
    rows = packing.pack(make(odd), model, capacity=512).collect()
    check(rows, odd, tokenizer, 512)
    assert packing.pack(make([]), model).count() == 0


def test_kept_ids(spark, make, model, tokenizer):
    docs = [(1, "a few words"), (2, "b " * 700)]
    for r in packing.pack(make(docs), model, capacity=512, keep_ids=True).collect():
        ids = [*tokenizer.encode(dict(docs)[r.doc_id], add_special_tokens=False).ids, 0]
        assert r.ids == ids[r.start:r.start + r.length]


def test_query(spark, sf, documents, tokenizer):
    rows = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    used = check(rows, documents, tokenizer, 2048)
    assert used <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_long_pieces_are_not_kept():
    rnd = random.Random(12)
    ids = packing.WordIds(tokenizer_file("word_bpe_49k.json"), 0)
    long = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(3000)) for _ in range(6)]
    texts = ["some words here", *long, "z" * 64 + " " + "z" * 65, "more words, here!"]
    data, offsets = utf8(pa.array(texts))
    for _ in range(2):
        got, at = ids(data, offsets)
        for k, t in enumerate(texts):
            assert got[at[k]:at[k + 1]].tolist() == [*ids.tok.encode(t, add_special_tokens=False).ids, 0]
    assert len(ids.slot) == len({"some", "words", "here", "z" * 64, "more", ",", "!"}) and ids.ids < 100
