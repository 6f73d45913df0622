"""Operator 4 - personal data by bootstrapped contextual extraction.

Base: e-mail addresses, IP addresses, card numbers and phone numbers match by pattern
in every whole text.  They are the seeds.  The words around an identifier are lexical
patterns: the last word before it, the last two, the word after it, and the word on both
sides.  Patterns and instances (identifiers, known or not) form a graph; in each round

* a pattern's confidence for a kind is the share of its distinct instances that are
  known to be of the kind; it counts from ``SUPPORT`` such instances and a confidence of
  ``CONFIDENCE``;
* an unknown instance that such patterns extract, with a joint confidence (1 minus the
  product of their doubts) of ``ACCEPT``, becomes known and is a seed of the next round.

Rounds go on until one finds nothing new; what is found only grows, so they end.  Texts are read once; the
rounds work on the stored distinct edges of the graph, with sums and joins only.

Unknown instances are what can fill a pattern's slot and has an identifier's shape: single
tokens with an at sign or with ``DIGITS`` digits, and runs of digit groups with blanks,
brackets, dots or hyphens between them and as many digits, that no base match touches.  A
kind's shape counts in the score: one without ``DIGITS`` digits can only be an address, and
one with an at sign nothing else.  What is found has the kind ``ctx_`` and the seed's kind.

Spans are in code points, end exclusive.  They come from the lengths of the matches and of
the text between them, so that DataFrame functions suffice (no Python in tasks).

Defined cases: null and empty texts have no spans; repeated rows and ids keep their rows,
rows are told apart by id and text (equal rows have equal results); ties need no order, as
scores decide alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, same_document, stored, text_or_empty

SUPPORT, CONFIDENCE, ACCEPT, DIGITS = 5, 0.8, 0.9, 4
#: Characters around an identifier in which its neighbouring words are looked for; a word that they cut does not count.
BEFORE, AFTER = 160, 80
KINDS = ("email", "ip", "card", "phone")

# The kinds' patterns find the leftmost non-overlapping matches.  Their beginnings are fixed by what
# stands before (or the last match's end, \G) and their repeats give nothing back, so that no text takes
# more than linear time; where a run fails, every later start inside it would fail in the same way.
_MATCH = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of digits with single separators that have 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # runs of digit groups (not within a token), tokens with an at sign, tokens with a digit
    "other": r"(?:(?<![A-Za-z0-9@._%+()-])(?<![0-9)][ (])\+?\(?[0-9]++(?:(?:\) ?|[ .-]?\(|[ .-])[0-9]++)++(?![A-Za-z0-9@_%+])"
             r"|(?<![A-Za-z0-9@._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9@._%+-]++"
             r"|(?<![A-Za-z0-9@._%+-])[A-Za-z@._%+-]*+[0-9][A-Za-z0-9@._%+-]*+)",
}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])?"
_DIGITS_OF = "regexp_replace({v}, '[^0-9]', '')"
#: Sum of the digits from the right, every second one doubled (9 less where that is over 9).
_LUHN = ("aggregate(sequence(1, length({d})), 0, (t, i) -> t + "
         "if(i % 2 = 1, int(substr({d}, -i, 1)), int(substr({d}, -i, 1)) * 2 - if(int(substr({d}, -i, 1)) > 4, 9, 0))) % 10 = 0")
#: What a match has to hold besides its pattern (SQL over a struct x with the value v).
_HOLDS = {
    "email": "true",
    "ip": rf"x.v RLIKE r'^{_PART}(?:\.{_PART}){{3}}$'",
    "card": _LUHN.format(d=_DIGITS_OF.format(v="x.v")),
    "phone": f"length({_DIGITS_OF.format(v='x.v')}) BETWEEN 8 AND 15",
    "other": f"instr(x.v, '@') > 0 OR length({_DIGITS_OF.format(v='x.v')}) >= {DIGITS}",
}


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``value`` computed once under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _sums_before(d: str) -> str:
    """SQL: for each item of the int array ``d`` the sum of those before it; in parts of 64, as appending copies."""
    part, parts = "slice(d, j * 64 + 1, 64)", "sequence(0, (size(d) - 1) div 64)"
    run = "(a, x) -> named_struct('at', a.at + x, 'out', array_append(a.out, a.at)), a -> a.out"
    start = "named_struct('at', {at}, 'out', cast(array() AS array<int>))"
    sums = f"transform({parts}, j -> aggregate({part}, 0, (t, x) -> t + x))"
    return _let("d", d, _let("c", f"aggregate({sums}, {start.format(at='0')}, {run})",
                             f"flatten(transform({parts}, j -> aggregate({part}, {start.format(at='c[j]')}, {run})))"))


def _located(kind: str) -> Column:
    """Array of (s, e, v, l, r): a kind's matches with the last characters before and the first after each.

    From the columns m_kind (matches) and g_kind (the text around them, one more).
    """
    m, g = f"m_{kind}", f"g_{kind}"
    sizes = f"zip_with(slice({g}, 1, size({m})), {m}, (a, b) -> length(a) + length(b))"
    one = (f"named_struct('s', p[i] + length({g}[i]), 'e', p[i] + length({g}[i]) + length(v), 'v', v, "
           f"'l', right({g}[i], {BEFORE}), 'r', left({g}[i + 1], {AFTER}))")
    return F.expr(f"filter({_let('p', _sums_before(sizes), f'transform({m}, (v, i) -> {one})')}, x -> {_HOLDS[kind]})")


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, email, ip, card, phone, other): each text's matches, as arrays of (s, e, v, l, r)."""
    t = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), text_or_empty(text_col).alias("t"))
    parts = t.select("id", "text_key", *[c for k, p in _MATCH.items() for c in
                                         (F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"m_{k}"), F.split("t", p, -1).alias(f"g_{k}"))])
    return parts.select("id", "text_key", *[_located(k).alias(k) for k in _MATCH])


#: Characters of a cell: spans meet in the cells that they touch, so that no two lists are compared as a whole.
CELL = 64


def unknown(found: DataFrame) -> DataFrame:
    """(id, text_key, s, e, v, l, r): the other candidates that no base match touches."""
    cells = F.explode(F.expr(f"sequence(s div {CELL}, (e - 1) div {CELL})"))
    base = F.concat(*[F.transform(k, lambda x: F.struct(x["s"], x["e"])) for k in KINDS])
    taken = (found.select("id", "text_key", F.explode(base).alias("x")).select("id", "text_key", "x.s", "x.e").distinct()
             .select(F.col("id").alias("b_id"), F.col("text_key").alias("b_key"), F.col("s").alias("b_s"), F.col("e").alias("b_e"), cells.alias("b_cell")))
    other = found.select("id", "text_key", F.explode("other").alias("x")).select("id", "text_key", "x.*").distinct()
    touched = (other.withColumn("cell", cells)
               .join(taken, F.col("id").eqNullSafe(F.col("b_id")) & F.expr("text_key = b_key AND cell = b_cell AND s < b_e AND b_s < e"), "left_semi")
               .select(F.col("id").alias("b_id"), F.col("text_key").alias("b_key"), F.col("s").alias("b_s")).distinct())
    return other.join(touched, F.col("id").eqNullSafe(F.col("b_id")) & F.expr("text_key = b_key AND s = b_s"), "left_anti")


def graph(found: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct edges (pattern, kind, value); kind is null for instances that are not known."""
    rows = None
    for k in (*KINDS, "other"):
        one = (other.select(F.struct("v", "l", "r").alias("x")) if k == "other" else found.select(F.explode(k).alias("x"))).select(
            F.lit(None if k == "other" else k).cast("string").alias("kind"), F.col("x.v").alias("value"),
            F.split(F.trim(F.lower("x.l")), r"\s+").alias("l"), F.split(F.trim(F.lower("x.r")), r"\s+").alias("r"),
            (F.length("x.l") >= BEFORE).alias("cut_l"), (F.length("x.r") >= AFTER).alias("cut_r"))
        one = one.select("kind", "value", F.when(F.col("cut_l") & (F.size("l") <= 2), F.slice("l", F.lit(2), F.size("l"))).otherwise(F.col("l")).alias("l"),
                         F.when(F.col("cut_r") & (F.size("r") == 1), "").otherwise(F.col("r")[0]).alias("r"))
        rows = one if rows is None else rows.union(one)
    last, two = F.element_at("l", -1), F.array_join(F.slice("l", -2, 2), " ")
    pattern = F.array(F.concat(F.lit("a "), last),
                      F.when(F.size("l") > 1, F.concat(F.lit("b "), two)),
                      F.concat(F.lit("c "), F.col("r")),
                      F.concat(F.lit("d "), last, F.lit(" _ "), F.col("r")))
    named = rows.where(F.size("l") > 0).withColumn("l", F.when(F.size("l") == 1, F.array(F.lit(""), F.col("l")[0])).otherwise(F.col("l")))
    return (named.select("kind", "value", F.explode(pattern).alias("pattern"))
            .where(F.substr("pattern", F.lit(3)).rlike(r"\p{L}"))  # a pattern has a word in it
            .distinct())


def bootstrap(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame:
    """(value, kind): the unknown instances that become known, up to the fixed point."""
    edges = stored(edges, "pii-edges")
    size = stored(edges.groupBy("pattern").agg(F.count_distinct("value").alias("n")), "pii-patterns")
    seeds = edges.where("kind IS NOT NULL").select("value", "kind").distinct()
    found, before = None, 0
    while True:
        known = seeds if found is None else seeds.union(found)
        hits = (edges.select("pattern", "value").distinct().join(known, "value")
                .groupBy("pattern", "kind").agg(F.count_distinct("value").alias("f")).where(F.col("f") >= support))
        good = hits.join(size, "pattern").withColumn("c", F.col("f") / F.col("n")).where(F.col("c") >= confidence).select("pattern", "kind", "c")
        fresh = edges.where("kind IS NULL").select("pattern", "value").distinct().join(good, "pattern")
        fresh = fresh.where("kind = 'email' OR instr(value, '@') = 0")
        score = (fresh.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("c"), F.lit(1e-9)))))).alias("score"))
                 .where(F.col("score") >= accept))
        best = score.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        found = stored(best if found is None else best.join(found, "value", "left_anti").union(found), "pii-found")
        now = found.count()
        if now == before:
            return found
        before = now


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: float) -> DataFrame:
    """One row per document row: id, text_key, spans: array of (kind, s, e), base kinds first, then the found ones."""
    found = stored(located(docs, id_col, text_col), "pii-located")
    other = stored(unknown(found), "pii-unknown")
    new = bootstrap(graph(found, other), **how)
    extra = (other.withColumnRenamed("v", "value")
             .join(new, "value")
             .groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_key"))
             .agg(F.array_sort(F.collect_set(F.struct(F.concat(F.lit("ctx_"), F.col("kind")).alias("kind"), "s", "e"))).alias("extra")))
    base = F.concat(*[F.expr(f"transform({k}, x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e))") for k in KINDS])
    joined = found.join(extra, found["id"].eqNullSafe(F.col("_id")) & (found["text_key"] == F.col("_key")), "left")
    none = F.array().cast("array<struct<kind: string, s: int, e: int>>")
    return joined.select(F.col("id").alias(id_col), "text_key", F.concat(base, F.coalesce("extra", none)).alias("spans"))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: float) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle brackets."""
    id_, key, spans_ = fresh(docs, "id", "key", "spans")
    spans = (personal_data(docs, id_col, text_col, **how).where(F.size("spans") > 0).dropDuplicates([id_col, "text_key"])
             .select(F.col(id_col).alias(id_), F.col("text_key").alias(key), F.col("spans").alias(spans_)))
    joined = docs.join(spans, same_document(id_col, text_col, id_, key), "left")
    # from left to right; where spans of two kinds overlap, the earlier one covers the rest
    text = F.expr(f"""aggregate(array_sort({spans_}, (a, b) -> CASE WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 ELSE b.e - a.e END),
        named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct('at', greatest(a.at, x.e), 'out', concat(a.out,
            if(x.s >= a.at, concat(substr({text_col}, a.at + 1, x.s - a.at), '<', x.kind, '>'), ''))),
        a -> concat(a.out, substr({text_col}, a.at + 1)))""")
    return joined.withColumn(text_col, F.when(F.col(spans_).isNull(), F.col(text_col)).otherwise(text)).select(*[f"`{c}`" for c in docs.columns])
