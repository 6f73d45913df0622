"""Operator 12 - filter interaction audit by higher-order folds over all orders of the filters.

What a chain of filters does to a document depends only on which filters it fails: a
mask with one bit a filter.  So documents are counted by (part, mask) first, with the
counts of good and of toxic ones beside them; a part has 2^k cells at most.  Each cell
folds across the array of all k! orders (a literal that every task has): ``transform``
over the orders, ``aggregate`` over the steps of one, which gives k! * k structs weighted
by the cell's counts.  A part's cells are merged by elementwise sums of these arrays.

The last filter fails a document whose text an earlier document (a smaller id) has too,
anywhere in the table.  Texts meet as SHA-256 digests.  A document is the first with its
text if it matches (digest, least id), a key that copies do not share, so a group of
copies of any size is spread over the tasks.

Defined cases: null text is empty; null part is the empty string; a null id comes after
all others (null ids do not precede each other) and has no labels; rows with one id are
not each other's copies, equal rows each count; several label rows of an id give each
label that one of them gives; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import stored, text_or_empty

#: Filters at most: 720 orders of 6 steps.
MOST = 6
#: White space between words, as the characters of a trim and as a class.
_SPACES, _BETWEEN = " \t\n\x0b\x0c\r", r"[ \t-\r]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_filters(text: Column) -> dict[str, Column]:
    """The production filters of one text: whether it fails each."""
    shown = F.btrim(text, F.lit(_SPACES))
    words = F.when(shown == "", F.array().cast("array<string>")).otherwise(F.split(shown, _BETWEEN, -1))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < 100,
            "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
            "C": 100 * capitals.cast("long") > 10 * F.length(text),
            "D": text.rlike(r"[#$%&*|]")}


def cells(docs: DataFrame, filters: dict[str, Column], copies: str, labels: DataFrame, part: Column,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail, ``copies`` being the last bit."""
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(filters.values())), F.lit(0))
    seen = docs.select(F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256)).alias("digest"), F.col(id_col).alias("id"),
                       F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"))
    seen = stored(seen.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "filter-masks")
    first = seen.groupBy("digest").agg(F.min("id").alias("first")).select(F.col("digest").alias("of"), "first")
    copy = F.when(F.col("of").isNull(), 1 << len(filters)).otherwise(0)
    by_id = (seen.join(first, (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left")
             .groupBy("id", "part", (F.col("mask") + copy).alias("mask")).agg(F.sum("n").alias("n")))
    label = labels.groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.col("quality") == 1).alias("g"), F.max(F.col("toxic") == 1).alias("t"))
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return (by_id.join(label, F.col("id") == F.col("labelled"), "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), count("g").alias("good"), count("t").alias("toxic")))


def audit(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of ``letters`` and step: what the step keeps and removes, and each filter's Shapley sum."""
    k = len(letters)
    if not 0 < k <= MOST or len(set(letters)) != k:
        raise ValueError(f"between 1 and {MOST} different letters")
    size = factorial(k) * k
    zero = "named_struct(" + ", ".join(f"'{c}', 0L" for c in COUNTS) + ")"
    bit = f"shiftleft(1, instr('{letters}', substring(o, i, 1)) - 1)"
    fails, alone = f"(c.mask & {bit}) <> 0", f"c.mask = {bit}"
    values = {"kept": f"if(s.alive AND NOT {fails}, c.n, 0L)", "removed": f"if(s.alive AND {fails}, c.n, 0L)",
              "redundant": f"if(NOT s.alive AND {fails}, c.n, 0L)", "unique_fails": f"if({alone}, c.n, 0L)",
              "good_lost": f"if(s.alive AND {fails}, c.good, 0L)", "toxic_lost": f"if(s.alive AND {fails}, c.toxic, 0L)"}
    step = "named_struct(" + ", ".join(f"'{c}', {values[c]}" for c in COUNTS) + ")"
    one_order = (f"aggregate(sequence(1, {k}), named_struct('alive', true, 'out', slice(array({zero}), 1, 0)), "
                 f"(s, i) -> named_struct('alive', s.alive AND NOT {fails}, 'out', concat(s.out, array({step}))), s -> s.out)")
    folded = f"flatten(transform(orders, o -> {one_order}))"
    added = "named_struct(" + ", ".join(f"'{c}', x.{c} + y.{c}" for c in COUNTS) + ")"
    merged = f"aggregate(cells, array_repeat({zero}, {size}), (a, c) -> zip_with(a, {folded}, (x, y) -> {added}))"
    at = lambda p: f"substring(orders[int({p} div {k})], int({p} % {k}) + 1, 1)"
    shapley = f"aggregate(sequence(0, {size - 1}), 0L, (a, p) -> a + if({at('p')} = {at('pos')}, merged[p].removed, 0L))"
    return (cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 2^k at most
            .withColumn("orders", F.array(*[F.lit("".join(p)) for p in permutations(letters)]))
            .withColumn("merged", F.expr(merged))
            .select("part", "orders", "merged", F.posexplode("merged").alias("pos", "v"))
            .select("part", F.expr(f"orders[int(pos div {k})]").alias("filter_order"), F.expr(f"int(pos % {k}) + 1").alias("step"),
                    "v.*", F.expr(shapley).alias("shapley")))


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of the production filters A to D and of E, copies of earlier texts."""
    found = cells(docs, text_filters(text_or_empty(text_col)), "E", labels, F.col(part_col), id_col, text_col)
    return audit(found, "ABCDE")


#: DuckDB: the audit over the whole tables.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END) AS fails, good, toxic
  FROM d LEFT JOIN l USING (doc_id)),
cell AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INT AS step, filter_order[step] AS x, filter_order[1:step - 1] AS before FROM o, range(1, 6) r(step)),
v AS (
  SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS here, fails = x AS alone,
         len(regexp_replace(before, '[^' || fails || '_]', '', 'g')) > 0 AS gone
  FROM cell, s),
r AS (
  SELECT part, filter_order, step, x, sum(CASE WHEN NOT gone AND NOT here THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND here THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN gone AND here THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN NOT gone AND here THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND here THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM v GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
"""
