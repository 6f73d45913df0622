import hashlib
import random
import re

from sparkmart.llm import pii
from sparkmart.llm.queries import QUERIES

BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def luhn(d):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def holds(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d),
            "phone": 8 <= len(d) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in p.finditer(text or "") if holds(k, m[0])]


def spans(df):
    return sorted([(r.doc_id, [tuple(s) for s in r.spans]) for r in df.collect()], key=str)


def test_base_spans_against_the_patterns(spark, make, odd):
    rnd = random.Random(1)
    alphabet = "0123456789" * 2 + "..  --++@@ab()%_é\U0001f600\n"
    rows = list(odd)
    for i in range(1500):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        if i % 3 == 0:
            d = "".join(str(rnd.randint(0, 9)) for _ in range(rnd.randint(14, 19)))
            d += next(str(c) for c in range(10) if luhn(d + str(c)))
            s += rnd.choice(["", " ", "x", "-"]) + "".join(c + rnd.choice(["", "", "-", " "]) for c in d) + rnd.choice(["", "a", "  1"])
        rows.append((100 + i, s))
    rows += [(9001, "1.2.3.4.5.6.7.8 001.0002.3.255 1.2.3.256 0.0.0.0 a@b.c_d@e.f"), (9002, "x" * 40_000 + "@"), (9003, "1 " * 20_000),
             (9004, "1-" * 9 + "  " + "+1" * 3000), (9005, "a@b.c " * 5000), (9006, "4111 1111 1111 1111, " * 1000), (9007, "a@" + "b." * 9000 + "c")]
    got = [(i, [s for s in x if not s[0].startswith("ctx_")]) for i, x in spans(pii.personal_data(make(rows)))]
    assert got == sorted([(i, base(t)) for i, t in rows], key=str)
    assert pii.personal_data(make([])).count() == 0


def plain_bootstrap(edges):
    """The rounds over a set of (pattern, kind, value)."""
    known = {(v, k) for _, k, v in edges if k}
    found = {}
    size = {}
    for p, _, v in edges:
        size.setdefault(p, set()).add(v)
    while True:
        now = known | set(found.items())
        good = {}
        for p, values in size.items():
            for kind in {k for _, k in now}:
                f = sum((v, kind) in now for v in values)
                if f >= pii.SUPPORT and f / len(values) >= pii.CONFIDENCE:
                    good[p, kind] = f / len(values)
        score = {}
        for v in {v for _, k, v in edges if not k}:
            for kind in {k for _, k in good}:
                doubt = 1.0
                for (p, k), c in good.items():
                    if k == kind and (p, None, v) in edges:
                        doubt *= max(1 - c, 1e-9)
                if 1 - doubt >= pii.ACCEPT:
                    score[v, kind] = 1 - doubt
        new = {v: max((s, k) for (w, k), s in score.items() if w == v)[1] for v in {v for v, _ in score}}
        if set(new) <= set(found):
            break
        found = {**new, **found}
    return found


def test_contexts_discover_unseen_identifiers(spark, make):
    rows = [(i, f"please call phone +1 (604) 555-{1000 + i} now and thanks") for i in range(9)]
    rows += [(50, "please call phone 5551234 now and thanks"), (51, "another 7654321 number, no context"), (52, "the code 5551234 again")]
    rows += [(60 + i, f"reach admin user{i}@mail.example.org for help") for i in range(7)] + [(70, "reach admin bob99887 for help")]
    got = dict(spans(pii.personal_data(make(rows))))
    assert got[50] == [("ctx_phone", 18, 25)] and got[51] == [] and got[52] == [("ctx_phone", 9, 16)]
    assert got[70] == [("ctx_email", 12, 20)]
    assert got[0] == base(rows[0][1])


def test_identifiers_without_digits_and_with_blanks(spark, make):
    rows = [(i, f"reach admin user{i}@mail.example.org for help") for i in range(9)] + [(20, "reach admin alice@intranet for help")]
    rows += [(100 + i, f"please call phone +1 (604) 555-{1000 + i} now") for i in range(30)]
    rows += [(50, "please call phone 555 12 34 now"), (51, "please call phone (604) 555-1234 now"), (52, "please call phone 12 now"),
             (53, "please call phone 604.555.9876, or 555 77 66"), (54, "please call phone bob@intranet now")]
    rows += [(60, "no context for 555 99 88 and eve@intranet"), (61, "555 12 34 again, alice@intranet too")]
    texts, got = dict(rows), dict(spans(pii.personal_data(make(rows))))
    found = {i: [(k, texts[i][s:e]) for k, s, e in x if k.startswith("ctx_")] for i, x in got.items()}
    assert found[20] == [("ctx_email", "alice@intranet")] and found[50] == [("ctx_phone", "555 12 34")] and found[51] == [("ctx_phone", "(604) 555-1234")]
    assert found[53] == [("ctx_phone", "604.555.9876")]
    assert found[52] == found[60] == [] and not any(k == "ctx_phone" for k, _ in found[54])
    assert found[61] == [("ctx_email", "alice@intranet"), ("ctx_phone", "555 12 34")]


def test_words_that_the_context_cuts_do_not_count(spark, make):
    # the long words differ in their far ends only; cut, they would be one pattern with nine seeds
    rows = [(i, f"{chr(97 + i)}{'x' * 400} +1604555{1000 + i}") for i in range(9)] + [(20, f"z{'x' * 400} 5551234")]
    assert dict(spans(pii.personal_data(make(rows))))[20] == []
    rows = [(i, f"{'y' * 100} +1604555{1000 + i}") for i in range(12)] + [(20, f"{'y' * 100} 5551234")]
    assert dict(spans(pii.personal_data(make(rows))))[20] == [("ctx_phone", 101, 108)]


def test_candidates_take_linear_time(spark, make):
    rows = [(1, "1) " * 60_000 + "x"), (2, "1 " * 60_000 + "@"), (3, "(1" * 60_000 + "z"), (4, "a." * 60_000), (5, "1.1-1 1(" * 20_000 + "q"), (6, "a@" * 50_000)]
    assert pii.personal_data(make(rows)).count() == 6


def test_rounds_against_brute_force(spark):
    rnd = random.Random(5)
    values = [(f"v{i}", rnd.choice(["ip", "email", None, None])) for i in range(120)]
    edges = {(f"a w{rnd.randrange(12) if k != 'ip' else rnd.randrange(4)}", k, v) for v, k in values for _ in range(3)}
    edges |= {(f"b z{i % 5}", k, v) for i, (v, k) in enumerate(values) if k == "ip" or i % 9 == 0}
    df = spark.createDataFrame(sorted(edges, key=str), "pattern string, kind string, value string")
    got = {r.value: r.kind for r in pii.bootstrap(df).collect()}
    assert got == plain_bootstrap(edges)


def test_rounds_go_on_to_the_fixed_point(spark):
    hops = 8
    edges = [(p, "phone", f"s{i}") for h in range(1, hops + 1) for p in (f"a p{h}", f"c q{h}") for i in range(5 if h == 1 else 4)]
    edges += [(p, None, f"u{k}") for h in range(1, hops + 1) for p in (f"a p{h}", f"c q{h}") for k in (h - 1, h) if k]
    got = {r.value: r.kind for r in pii.bootstrap(spark.createDataFrame(edges, "pattern string, kind string, value string")).collect()}
    assert got == {f"u{k}": "phone" for k in range(1, hops + 1)}


def test_masked(spark, make):
    out = {r._id: r.text for r in pii.masked(make([(1, "mail a@b.c, host 1.2.3.4"), (2, None), (3, "none")])).collect()}
    assert out == {0: "mail <email>, host <ip>", 1: None, 2: "none"}


def test_query(spark, sf, documents):
    df = QUERIES["op4_bootstrapped_pii"](spark, sf)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(documents)
    for i, t in documents:
        b, r = base(t), got[i]
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and r.spans.startswith(shown)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in b) for k in BASE]
