import collections
import random
import re

import numpy as np
import pytest

from sparkmart.llm import minhash
from sparkmart.llm.components import components
from sparkmart.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(docs, k, percent):
    by, index = {}, collections.defaultdict(list)
    for n, (_, t) in enumerate(docs):
        by.setdefault(shingles(t, k), []).append(n)
    keys = [s for s in by if s]
    parent = list(range(len(keys)))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for n, s in enumerate(keys):
        for m, c in collections.Counter(m for e in s for m in index[e]).items():
            if 100 * c >= percent * (len(s) + len(keys[m]) - c):
                parent[top(n)] = top(m)
        for e in s:
            index[e].append(n)
    groups = collections.defaultdict(list)
    for n, s in enumerate(keys):
        groups[top(n)] += by[s]
    out = [(i, 0, i) for i, _ in docs]
    for members in groups.values():
        ids = [docs[m][0] for m in members if docs[m][0] is not None]
        for m in members:
            out[m] = (docs[m][0], len(shingles(docs[m][1], k)), min(ids) if ids else None)
    return sorted(out, key=str)


def copies(n, seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(5000)]
    text = [rnd.choice(vocab) for _ in range(150)]
    out = []
    for i in range(n):
        w = list(text)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 8, 12, 20])):
            w[rnd.randrange(150)] = rnd.choice(vocab)
        out.append((100 + i * 7 % 10007, " ".join(w)))
    return out + [(20_000 + i, f"same text here {i % 5}") for i in range(50)]


@pytest.mark.parametrize("block", [512, 37])
def test_components_against_brute_force(spark, make, odd, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)  # 37: the hot group is compared in many blocks
    docs = copies(400) + odd
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(make(docs, 5), 3, 85).collect()], key=str)
    assert got == brute(docs, 3, 85)


def test_forest_spans_the_links_of_a_block():
    rng = np.random.default_rng(4)
    for case in range(300):
        within, n, m = case % 2 == 0, int(rng.integers(1, 9)), int(rng.integers(1, 9))
        ok = rng.random((n, n if within else m)) < 0.25
        if within:
            np.fill_diagonal(ok, False)
        size = n if within else n + m
        joined = rng.random(size) < 0.4
        shift = 0 if within else n

        def parts(links):
            parent = list(range(size))

            def top(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            left = np.flatnonzero(joined).tolist()
            for a, b in [*zip(left, left[1:]), *links]:
                parent[top(a)] = top(b)
            return [[top(x) == top(y) for y in range(size)] for x in range(size)]

        got = minhash.forest(ok, within, joined)
        assert all(ok[a, b] or (within and ok[b, a]) for a, b in got) and len(got) <= size
        assert parts([(a, b + shift) for a, b in got]) == parts([(a, b + shift) for a, b in zip(*np.nonzero(ok))])


def test_links_of_a_template_family_do_not_grow_with_its_square(spark, make, monkeypatch):
    rnd = random.Random(2)
    text = [f"w{k}" for k in range(400)]
    docs = []
    for i in range(600):
        w = list(text)
        for k in rnd.sample(range(400), rnd.choice([5, 6, 7])):
            w[k] = f"own{i}x{k}"
        docs.append((i, " ".join(w)))
    seen = []
    real = minhash.components
    monkeypatch.setattr(minhash, "components", lambda edges: seen.append(edges.count()) or real(edges))
    got = [(r.doc_id, r.component_id) for r in minhash.near_duplicates(make(docs, 4), 3, 85).collect()]
    assert sorted(got) == [(i, c) for i, _, c in sorted(brute(docs, 3, 85))]
    assert seen[0] < 20 * len(docs)  # all links were 50,000 and more


def test_keep_one(spark, make, odd):
    docs = copies(60) + odd
    frame = make(docs)
    out = minhash.keep_one(frame, width=3, percent=85)
    assert out.columns == frame.columns
    want = {x[2] for x in brute(docs, 3, 85) if x[1] and x[2] is not None}
    assert sorted(r.doc_id for r in out.where("text rlike '[^ \\\\n\\\\t]'").collect() if r.doc_id is not None) == sorted(want)
    assert out.where("text is null or not text rlike '[^ \\\\n\\\\t]'").count() == 4  # texts without words all stay
    assert minhash.near_duplicates(make([])).count() == 0


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2400], rng.integers(0, 2**64, 600, dtype=np.uint64)])
    same = (minhash.signature(a, 500) == minhash.signature(b, 500)).mean()
    assert abs(same - 2400 / 3600) < 0.08


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, i) for i in range(2001, 2200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    assert got == {x: top(x) for x in list(parent)}


def test_query(spark, sf, documents):
    rows = QUERIES["op6_circulant_minhash"](spark, sf).collect()
    assert sorted([(r[0], r[1], r[2]) for r in rows], key=str) == brute(documents, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
