"""Operator 5 - benchmark decontamination by a broadcast hash set of test n-grams.

Texts are lower-cased (A-Z) and read as words.  A window is ``ngram`` words of a
benchmark item in a row; an item of fewer words is one window.  A document word
inside any occurrence of a window is hit.

Scanning: an occurrence of a 10-word window always covers one whole 6-word block
that starts at a multiple of 5 in the document.  So the documents probe only these
blocks against a broadcast table of all 6-word pieces of the windows, and the few
that meet are verified word by word as whole windows.  Nothing is missed and a
fifth of the positions is probed.  Shorter items (if there are any) are probed at
every position with their own length.  The table is broadcast only while it has at most
``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes, which are counted first, and one
pass over the documents does all.  Beyond that the probes alone (id, text key, position,
key) are shuffled to the table, and the words of the few documents that meet it are
fetched afterwards, once each.  Everything is DataFrame functions.

Defined cases: null text has no words; a null item id counts as the id ``null``;
repeated items count once; null and repeated document ids keep all their rows, and
rows are told apart by id and text (equal rows have equal results); empty tables
give no hits or no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, same_document, stored

NGRAM = 10
#: Rows of the broadcast table at most, and bytes of its texts.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 128 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What words do not consist of, as they stand in the text (both cases of A-Z are letters here).
_OTHER = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A text's normalised words; null has none."""
    parts = F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN, -1)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _joined(words_: str, start: str, n: str) -> str:
    """SQL: ``n`` words from position ``start`` (from 0), as one string."""
    return f"concat_ws(' ', slice({words_}, {start} + 1, {n}))"


def _key(n: str, words_: str, start: str, k: str) -> str:
    return f"xxhash64({n}, {_joined(words_, start, k)})"


def scan_shape(n: int, ngram: int) -> tuple[int, int]:
    """(stride, block words) that cannot miss a window of ``n`` words."""
    if n < ngram:
        return 1, n
    stride = max(1, ngram // 2)
    return stride, ngram - stride + 1


def windows(benchmark: DataFrame, ngram: int, id_col: str, text_col: str) -> DataFrame:
    """(n, window, items, key, d): each distinct window, once for every block of it that a scan may meet.

    ``d`` is the block's position in the window.
    """
    items = (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                              words(F.col(text_col)).alias("w"))
             .where(F.size("w") > 0)
             .withColumn("n", F.least(F.size("w"), F.lit(ngram))))
    per_window = (items.select("item", "w", "n", F.explode(F.expr("sequence(0, size(w) - n)")).alias("i"))
                  .select("item", "n", F.expr("slice(w, i + 1, n)").alias("w"))
                  .groupBy("n", "w").agg(F.collect_set("item").alias("items")))
    stride, block = scan_shape(ngram, ngram)
    return (per_window
            .withColumn("d", F.explode(F.expr(f"sequence(0, if(n < {ngram}, 0, {stride - 1}))")))
            .select("n", F.concat_ws(" ", "w").alias("window"), "items", "d",
                    F.expr(_key("n", "w", "d", f"if(n < {ngram}, n, {block})")).alias("key")))


def scan(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row: id, text_key, n_words, hits (positions of hit words), items (ids as text, sorted)."""
    table = stored(windows(benchmark, ngram, item_col, item_text), "windows")
    lengths = sorted(r[0] for r in table.select("n").distinct().collect())  # at most ``ngram`` values
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")) + 50).alias("bytes")).first()
    probes = []
    for n in lengths:
        stride, block = scan_shape(n, ngram)
        probes.append(f"if(size(w) < {n}, array(), transform(sequence(0, greatest(size(w) - {block}, 0), {stride}), "
                      f"p -> named_struct('p', p, 'key', {_key(str(n), 'w', 'p', str(block))})))")
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), words(F.col(text_col)).alias("w"))
    if size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        found = _scan_once(own, table, probes)
    else:
        found = _scan_shuffled(own, table, probes)
    return (found.withColumn("_", F.explode(F.expr("sequence(1L, rows)")))  # equal rows come back as often as they came
            .select(F.col("id").alias(id_col), "text_key", "n_words",
                    F.expr("array_sort(array_distinct(flatten(transform(at, x -> sequence(x.s, x.s + x.n - 1)))))").alias("hits"),
                    F.expr("array_sort(array_distinct(flatten(items)))").alias("items")))


#: SQL: whether the window of a table row stands around the probe at ``p``.
_VERIFIED = f"p >= d AND p - d + n <= size(w) AND {_joined('w', 'greatest(p - d, 0)', 'n')} = window"


def _scan_once(own: DataFrame, table: DataFrame, probes: list[str]) -> DataFrame:
    """(id, text_key, n_words, rows, at, items) with the table broadcast: one pass over the documents."""
    # the mark that keeps a row for each document, hit or not, meets itself in the table
    table = F.broadcast(table.unionByName(table.sparkSession.sql("SELECT 0 n, '' window, array('') items, 0 d, xxhash64(-1) key")))
    mark = "array(named_struct('p', -1, 'key', xxhash64(-1)))"
    seen = (own.withColumn("probes", F.expr(f"concat({', '.join([mark, *probes])})"))
            # outer: every row has its mark, and an inner one would filter on the whole expression once more
            .select("id", "text_key", "w", F.inline_outer("probes")))
    met = (seen.join(table, "key").where(f"p = -1 OR ({_VERIFIED})")
           .select("id", "text_key", F.size("w").cast("long").alias("n_words"), "p",
                   F.expr("if(p < 0, NULL, named_struct('s', p - d, 'n', n))").alias("at"),
                   F.expr("if(p < 0, NULL, items)").alias("items")))
    return (met.groupBy("id", "text_key", "n_words")
            .agg(F.count_if(F.col("p") < 0).alias("rows"), F.collect_set("at").alias("at"), F.collect_set("items").alias("items")))


def _scan_shuffled(own: DataFrame, table: DataFrame, probes: list[str]) -> DataFrame:
    """The same with a shuffled table: probes without words meet it, and what meets is verified document by document."""
    heads = own.groupBy("id", "text_key", F.size("w").cast("long").alias("n_words")).agg(F.count(F.lit(1)).alias("rows"))
    seen = own.withColumn("probes", F.expr(f"concat({', '.join(probes)})") if probes else F.expr("array(named_struct('p', 0, 'key', 0L))"))
    # outer: an inner one would filter on the whole expression once more
    probed = seen.select("id", "text_key", F.inline_outer("probes"))
    met = probed.join(table.hint("merge"), "key").select("id", "text_key", "p", "n", "d", "window", "items")
    met = stored(met.distinct(), "met").select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "p", "n", "d", "window", "items")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    some = own.join(met.select("_id", "_key").distinct(), same, "left_semi").dropDuplicates(["id", "text_key"])
    hits = (some.join(met, same).where(_VERIFIED).groupBy("_id", "_key")
            .agg(F.collect_set(F.expr("named_struct('s', p - d, 'n', n)")).alias("at"), F.collect_set("items").alias("items")))
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    return (heads.join(hits, same, "left")
            .select("id", "text_key", "n_words", "rows", none("at", "array<struct<s: int, n: int>>"), none("items", "array<array<string>>")))


def remove_documents(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, **cols: str) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    id_col, text_col = cols.get("id_col", "doc_id"), cols.get("text_col", "text")
    id_, key = fresh(docs, "id", "key")
    hit = (scan(docs, benchmark, ngram, **cols).where(F.size("hits") > 0)
           .select(F.col(id_col).alias(id_), F.col("text_key").alias(key)).distinct())
    return docs.join(hit, same_document(id_col, text_col, id_, key), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, **cols: str) -> DataFrame:
    """``docs`` with the hit words, and what stands before each, cut out of the texts."""
    id_col, text_col = cols.get("id_col", "doc_id"), cols.get("text_col", "text")
    id_, key, hits = fresh(docs, "id", "key", "hits")
    hit = (scan(docs, benchmark, ngram, **cols).where(F.size("hits") > 0)
           .select(F.col(id_col).alias(id_), F.col("text_key").alias(key), F.col("hits").alias(hits)).dropDuplicates([id_, key]))
    joined = docs.join(hit, same_document(id_col, text_col, id_, key), "left")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(f"[{_OTHER}]*[^{_OTHER}]+"), F.lit(0))
    # the pieces are found once (x) and their positions told apart by a hash set
    left = F.transform(F.array(pieces), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(hits)), lambda i: F.get(x, i)))
    kept = F.get(left, F.lit(0))
    tail = F.regexp_extract(F.col(text_col), f"[{_OTHER}]*$", 0)
    text = F.when(F.col(hits).isNull(), F.col(text_col)).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn(text_col, text).select(*[f"`{c}`" for c in docs.columns])


#: DuckDB: the digest of op5 over the whole tables.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
pos AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT doc_id, item_id, n, i FROM pos JOIN win USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
