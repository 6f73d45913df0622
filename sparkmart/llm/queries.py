"""The registered queries of the training-data operators, and their DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, filter_audit, langid, line_dedup, minhash, packing, pii, resampling, suffix_trees, token_counts, topk, toxicity
from ._common import held_out, read, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file, from where it is installed."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


@query("op1_multi_index_hashing", topk.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("embedding").isNotNull(), topk.sign_code()).alias("code"))
    return topk.top_k(codes, codes.where("id % 50 = 0"), k=10)


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return (packing.pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=0)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


@query("op3_preference_format", chat.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.format_preferences(chat.swapped_replies(read(spark, sf_dir, "conversations")))
    runs = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["loss"], x["length"])), ",").alias(c)
    return out.select("pair_id", "n_prompt_turns", "prompt", "chosen", runs("chosen_mask"), "rejected", runs("rejected_mask"))


@query("op4_bootstrapped_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(read(spark, sf_dir, "documents"))
    shown = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.KINDS))
    n = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) AS bigint) AS n_{k}") for k in pii.KINDS]
    return out.select("doc_id", *n, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


@query("op5_benchmark_decontamination", decontaminate.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


@query("op6_circulant_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, tokenizer_file("piece_bpe_32k.model"))
    return counted.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op8_toxicity_cnn")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = toxicity.fit(docs, read(spark, sf_dir, "labels"), learn=~held_out())
    return (toxicity.with_toxicity(docs, net)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "toxic_in_lang"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(docs.where(~held_out()))
    return langid.with_language(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op10_line_alignment")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    before = docs.select("doc_id", "text", F.length("text").alias("chars"))
    out = line_dedup.deduplicate(before)
    return out.select("doc_id", F.col("chars").cast("long").alias("n_chars_before"), F.length("text").cast("long").alias("n_chars_after"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), (F.length("text") < F.col("chars")).alias("changed"))


@query("op11_suffix_tree_dedup", suffix_trees.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_trees.deduplicate(read(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50)
    # a text that lost nothing is as it came: its words, joined by one space, are what the digest is of
    words = F.array_join(F.split(F.btrim(text_or_empty(), F.lit(" \t\n\x0b\x0c\r")), r"[ \t-\r]+", -1), " ")
    return out.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


@query("op12_filter_interactions", filter_audit.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op13_importance_resampling", resampling.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (read(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return resampling.importance(docs, target, share=(10, 100), min_words=20, widths=(1, 1), buckets=10_000, seed=2024).select(
        F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
