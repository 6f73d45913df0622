import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm import suffix_trees
from sparkmart.llm._common import utf8
from sparkmart.llm.queries import QUERIES

W = 12


def words(t):
    return (t or "").encode().split()


def brute(docs, n=W):
    """{(id, text): (text after, words, words removed)}"""
    docs = set(docs)
    least = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            x = tuple(w[k:k + n])
            least[x] = min(least.get(x, (True, 0)), (i is None, i or 0))
    out = {}
    for i, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1):
            if least[tuple(w[k:k + n])] < (i is None, i or 0):
                gone.update(range(k, k + n))
        out[i, t] = (b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else t, len(w), len(gone))
    return out


def corpus(n=90, seed=4):
    rnd = random.Random(seed)
    text = lambda k: [f"w{rnd.randrange(400)}" for _ in range(k)]
    pool = [text(rnd.randint(W - 2, 40)) for _ in range(12)]
    hot = text(30)
    rows = []
    for i in range(n):
        own = text(rnd.randrange(60))
        for part in rnd.sample(pool, rnd.randrange(3)) + [hot] * (i % 3 == 0):
            at = rnd.randrange(len(own) + 1)
            own[at:at] = part[rnd.randrange(3):len(part) - rnd.randrange(3)]
        if i % 5 == 4:  # a near copy
            own = rows[rnd.randrange(len(rows))][1].split()
            if own:
                own[rnd.randrange(len(own))] = "changed"
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(own)))
    rows += [(200 + i, rows[7][1]) for i in range(25)] + [(3, rows[7][1]), (3, rows[7][1])]  # exact copies
    return rows


def check(make, rows, parts=4, n=W):
    frame = make(rows, parts)
    out = suffix_trees.deduplicate(frame, n)
    assert out.columns == [*frame.columns, "n_words", "n_removed"]
    want = brute(rows, n)
    got = out.collect()
    assert len(got) == len(rows) and all(r.piece == 7 for r in got)
    assert {r._id: (r.doc_id, r.text, r.n_words, r.n_removed) for r in got} == {k: (d[0], *want[d]) for k, d in enumerate(rows)}


@pytest.mark.parametrize("group", [250_000, 40, 4])
def test_against_brute_force(spark, make, odd, monkeypatch, group):
    monkeypatch.setattr(suffix_trees, "GROUP", group)  # 40, 4: prefixes of two blocks, and full ones
    rows = corpus() + [(None, corpus()[0][1]), (None, corpus()[0][1] + " more"), (300, "r " * 70), (301, "r " * 40), (302, "日本 é\xa0x " * 20), (303, "日本 é\xa0x " * 9)]
    check(make, rows + odd)


def test_no_smaller_id_no_repeat(spark, make):
    check(make, [(1, "a b c d e f " * 4), (1, "x a b c d e f " + "a b c d e f " * 3), (2, "short")])
    check(make, [(None, "a b c d e f " * 4), (None, "x " + "a b c d e f " * 4)])
    assert suffix_trees.deduplicate(make([])).count() == 0
    check(make, [(1, None), (2, ""), (3, " \n")])
    with pytest.raises(ValueError):
        suffix_trees.deduplicate(make([]), 2)


def test_names_that_the_input_has(spark, make):
    rows = [(1, "a b c d e f " * 4), (2, "a b c d e f " * 4)]
    frame = make(rows).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "starts")
    got = suffix_trees.deduplicate(frame, W)
    assert got.columns == [*frame.columns, "_n_words", "n_removed"]
    assert {(r.doc_id, r.text, r.n_words, r.starts, r._n_words, r.n_removed) for r in got.collect()} == {(1, rows[0][1], "en", "s", 24, 0), (2, "", "en", "s", 24, 24)}


def test_minimizers_and_subtrees():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(40))) for _ in range(30)]
    pieces = suffix_trees.Pieces(*utf8(pa.array(texts)))
    for n in (3, 7, 12):
        k, start = suffix_trees.piece_words(n), pieces.windows(n)
        assert len(start) == sum(max(0, len(t.split()) - n + 1) for t in texts)
        want = [min(int(pieces.hashes(np.array([p + j]), k)[0]) for j in range(n - k + 1)) for p in start]
        assert pieces.minimizers(start, n).tolist() == want
    rows = [[rnd.randrange(3) for _ in range(4)] for _ in range(200)]
    blocks, ids = [pa.array([r[c] for r in rows]) for c in range(3)], pa.array([None if r[3] == 2 else r[3] for r in rows])
    order, depth = suffix_trees.subtree(blocks, ids)
    assert [rows[i][:3] for i in order] == sorted(r[:3] for r in rows)
    assert all(rows[a][:d] == rows[b][:d] and (d == 3 or rows[a][d] != rows[b][d]) for a, b, d in zip(order, order[1:], depth[1:]))
    least = {tuple(r[:3]): min(x[3] for x in rows if x[:3] == r[:3]) for r in rows}
    assert sorted(suffix_trees.later_leaves(blocks, ids)) == [k for k, r in enumerate(rows) if r[3] > least[tuple(r[:3])]]


def test_query(spark, sf, documents):
    want = brute(documents, 50)
    got = QUERIES["op11_suffix_tree_dedup"](spark, sf).collect()
    assert len(got) == len(documents)
    texts = dict(documents)
    for r in got:
        text, n, gone = want[r.doc_id, texts[r.doc_id]]
        assert (r.n_words, r.n_removed) == (n, gone)
        assert r.kept_sha256 == hashlib.sha256(b" ".join(words(text))).hexdigest()
