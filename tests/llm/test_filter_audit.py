import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import filter_audit

WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int, toxic int, text string"


def failed(rows):
    """[(part, letters that the row fails, id)]"""
    out = []
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
        f += "D" * bool(re.search(r"[#$%&*|]", t))
        f += "E" * any(j is not None and (i is None or j < i) and (u or "") == t for j, u, _ in rows)
        out.append((part or "", f, i))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs, out = failed(rows), {}
    for part in {d[0] for d in docs}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            alive = {n for n, d in enumerate(docs) if d[0] == part}
            mine = set(alive)
            for step, x in enumerate(order, 1):
                fails = {n for n in mine if x in docs[n][1]}
                here = fails & alive
                ids = [docs[n][2] for n in here]
                out[part, order, step] = [len(alive - fails), len(here), len(fails - alive), sum(docs[n][1] == x for n in mine),
                                          sum(i in good for i in ids), sum(i in toxic for i in ids)]
                shapley[x] += len(here)
                alive -= fails
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def check(spark, rows, labels, parts=3):
    docs = spark.createDataFrame([(i, t, p, 1, "x") for i, t, p in rows], "doc_id long, text string, lang string, mask int, digest string").repartition(parts)
    got = filter_audit.filter_audit(docs, spark.createDataFrame([(*x, "clash") for x in labels], LABELS))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got.collect()} == brute(rows, labels)


def test_against_brute_force(spark, odd):
    rnd = random.Random(3)
    langs = ["en", "fr", None, ""]
    rows = [(i, t, rnd.choice(langs)) for i, t in odd]
    for i in range(60):
        n = rnd.choice([0, 5, 99, 100, 101, 140])
        w = [rnd.choice(["Aa", "BB", "c", "d\xa0e", "é", "$x", "plain"]) + str(rnd.randrange(rnd.choice([3, 200]))) for _ in range(n)]
        rows.append((rnd.randrange(40), rnd.choice([" ", "\n\t", "  "]).join(w), rnd.choice(langs)))
    rows += [(100 + i, "a copy of one text " * 30, "en") for i in range(20)] + [(100, "a copy of one text " * 30, "fr")] * 3
    rows += [(None, "a copy of one text " * 30, "en"), (None, "only without ids", "en"), (None, "only without ids", "en")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    check(spark, rows, labels)
    check(spark, rows, [], 1)


def test_empty_tables_and_general_orders(spark, make):
    empty = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(make([]), empty).count() == 0
    cells = spark.createDataFrame([("p", 1, 5, 2, 1), ("p", 3, 7, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.audit(cells, "XY").collect()}
    assert got == {("XY", 1): (0, 12, 0, 17), ("XY", 2): (0, 0, 7, 7), ("YX", 1): (5, 7, 0, 7), ("YX", 2): (0, 5, 7, 17)}
    assert filter_audit.audit(cells.where(F.lit(False)), "XY").count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "ABCDEFG")
