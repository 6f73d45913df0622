import collections
import hashlib
import random

from sparkmart.llm import line_dedup
from sparkmart.llm.queries import QUERIES


def brute(docs, min_words=line_dedup.MIN_WORDS):
    """{(id, text): new text}: all documents that share a line are aligned, pair by pair."""
    docs = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0))
    lines = [t.split("\n") for _, t in docs]
    words = [[len(x.split()) for x in ls] for ls in lines]
    held = collections.defaultdict(set)
    for n, ls in enumerate(lines):
        for x in ls:
            held[x].add(n)
    pairs = {(a, b) for h in held.values() for a in h for b in h if a < b}
    gone = collections.defaultdict(set)
    for a, b in pairs:
        gone[b].update(line_dedup.blocks(lines[a], lines[b], words[b], min_words))
    return {d: "\n".join(x for k, x in enumerate(lines[n]) if k not in gone[n]) for n, d in enumerate(docs)}


def test_patience_alignment():
    rnd = random.Random(2)
    for _ in range(2000):
        a, b = [[rnd.randrange(8) for _ in range(rnd.randrange(12))] for _ in "ab"]
        m = line_dedup.common_lines(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:]))
    assert line_dedup.common_lines([1, 2, 3, 4], [9, 2, 3, 8, 4]) == [(1, 1), (2, 2), (3, 4)]
    long = list(range(20_000))
    assert len(line_dedup.common_lines(long, [-1, *long, -2])) == 20_000
    assert line_dedup.blocks([1, 2, 3], [7, 1, 2, 8, 3], [9, 5, 5, 9, 4], 10) == [1, 2]


def corpus():
    rnd = random.Random(4)
    line = lambda: " ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(1, 14)))
    hot = [" ".join(f"h{k}x{i}" for i in range(9)) for k in range(5)]
    rows = []
    for i in range(60):
        own = [line() for _ in range(rnd.randint(0, 6))]
        if i % 2:
            own[len(own) // 2:len(own) // 2] = hot  # a passage in half of all documents
        if i % 7 == 3 and rows:
            own += rows[rnd.randrange(len(rows))][1].split("\n")[:4]
        rows.append((i, "\n".join(own)))
    return rows


def test_against_brute_force(spark, make, odd):
    rows = corpus() + [o for o in odd if o[0] != 6 and o[0] is not None] + [(None, corpus()[5][1]), (2, None)]
    frame = make(rows, 4)
    out = line_dedup.deduplicate(frame)
    want = brute(rows)
    assert out.columns == frame.columns and out.schema == frame.schema
    got = {r._id: r for r in out.collect()}
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(rows):
        assert got[n].text == (None if t is None else want[i, t])
        assert got[n].n_chars == (None if t is None else len(got[n].text))
    first = next(i for i, t in rows if "h0x0" in t)
    # the passage stays where it was first (a document that repeats its own lines keeps one more)
    assert [i for i, t in rows if t and t.count("h0x0") == 1 and "h0x0" in want[i, t]] == [first]
    kept = line_dedup.deduplicate(frame, drop_emptied=True)
    assert kept.count() == sum(t in (None, "") or want[i, t] != "" for i, t in rows)
    assert line_dedup.deduplicate(make([])).count() == 0


def test_query(spark, sf, documents):
    want = brute(documents)
    got = {r.doc_id: r for r in QUERIES["op10_line_alignment"](spark, sf).collect()}
    for i, t in documents:
        assert got[i].text_sha256 == hashlib.sha256(want[i, t].encode()).hexdigest()
        assert got[i].changed == (want[i, t] != t)


def all_pairs(rows, min_words=line_dedup.MIN_WORDS):
    """{id: new text}: every two documents are aligned."""
    lines = {i: t.split("\n") for i, t in rows}
    gone = collections.defaultdict(set)
    for a in lines:
        for b in lines:
            if a < b:
                gone[b].update(line_dedup.blocks(lines[a], lines[b], [len(x.split()) for x in lines[b]], min_words))
    return {i: "\n".join(x for k, x in enumerate(ls) if k not in gone[i]) for i, ls in lines.items()}


def test_passage_whose_lines_were_first_held_alone(spark, make):
    x, y, z = (" ".join(f"{c}{i}" for i in range(20)) for c in "xyz")
    rows = [(1, x), (2, y), (3, z)] + [(k, f"own {k}\n{x}\n{y}\n{z}\nend {k}") for k in range(4, 24)]
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(make(rows)).collect()}
    assert got == all_pairs(rows)
    assert got[4] == rows[3][1] and got[23] == "own 23\nend 23"


def test_candidates_reach_what_all_pairs_reach(spark, make):
    rnd = random.Random(8)
    pool = [" ".join(f"p{k}x{i}" for i in range(rnd.choice([0, 1, 3, 4, 9, 14, 30]))) for k in range(40)]
    rows = []
    for i in range(80):
        own = [f"own {i} {n}" for n in range(4)]
        for _ in range(2):
            k, at = rnd.randrange(40), rnd.randrange(5)
            own[at:at] = pool[k:k + rnd.randint(1, 6)]
        rows.append((i, "\n".join(own)))
    rows += [(100 + i, "\n".join(f"short line number n{k}" for k in range(20))) for i in range(3)]
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(make(rows)).collect()}
    want = all_pairs(rows)
    assert got == want and sum(want[i] != t for i, t in rows) > 20


def test_blocks_of_all_pairs_of_positions():
    assert line_dedup.blocks([1, 60, 3, 60, 5], [7, 60, 8], [1, 60, 1], 25) == [1]
    assert line_dedup.blocks([60, 61], [61, 60, 61], [30, 30, 30], 25) == [0, 1, 2]
    rnd = random.Random(6)
    for n in range(3000):
        words = [rnd.randrange(4) for _ in range(6)]
        a, b = [[rnd.randrange(6 if n % 2 else 3) for _ in range(rnd.randrange(14))] for _ in "ab"]
        want = set()
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                    k += 1
                if sum(words[x] for x in b[j:j + k]) >= 5:
                    want |= set(range(j, j + k))
        assert line_dedup.blocks(a, b, [words[x] for x in b], 5) == sorted(want)
    long = [k % 700 // 7 for k in range(20_000)]
    assert line_dedup.blocks(long, long[5:] + [-1] + long[:9_000], [1] * 28_996, 25) == [k for k in range(28_996) if k != 19_995]


def test_short_lines_and_scripts_without_spaces(spark, make):
    rows = [(i, f"own {i}\n" + "\n".join(f"a line {k} here" for k in range(20)) + f"\nend {i}") for i in range(2)]
    texts = ["".join(chr(0x4E00 + 7 * k) for k in range(60)), "これはながいぶんしょうです。" * 8, "ภาษาไทยไม่มีช่องว่าง" * 9]
    rows += [(10 * n + i, "\n".join([t, t[::-1], f"own {i}"])) for n, t in enumerate(texts, 1) for i in range(2)]
    rows += [(50, "short 日本語\nx"), (51, "short 日本語\ny")]
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(make(rows)).collect()}
    assert got == dict(rows) | {1: "own 1\nend 1", 11: "own 1", 21: "own 1", 31: "own 1"}
