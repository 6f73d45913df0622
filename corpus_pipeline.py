"""A training corpus from ``documents``: five stages, each one of the operators of ``sparkmart.llm``.

1. language ID: texts without a language (``und``), or in which no language holds a third of the score, go;
2. line dedup: passages that an earlier document has are cut out; documents that this empties go;
3. MinHash near-dedup (five-word shingles, similarity 0.8): one document of each group stays;
4. benchmark decontamination: documents that hold a ten-word window of a benchmark item go;
5. best-fit packing into sequences of 2048 tokens.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage as Parquet into the shared folder and reads it back for the next, so
that a stage survives the loss of executors and works on what its predecessor really kept.

Every stage handles nulls in any column, empty and very long texts, ties, repeated rows, empty tables and extra
columns, as its operator's docstring defines: a null or empty text is ``und`` and goes in the first stage; rows
that agree in id and text are one document from the third stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import decontaminate, langid, line_dedup, minhash, packing
from sparkmart.llm._common import fresh, held_out, read, stored
from sparkmart.llm.queries import tokenizer_file

#: A text whose best language has less than this share of the score has none.
LEAST_SCORE = 1 / 3
CAPACITY, END_ID = 2048, 0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; the network learns from the documents' own labels, but for the test fold."""
    net = langid.fit(docs.where(~held_out()))
    lang, score = fresh(docs, "lang_pred", "lang_score")
    named = langid.with_language(docs, net, lang_out=lang, score_out=score)
    return named.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have."""
    return line_dedup.deduplicate(docs, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the training sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), CAPACITY, END_ID)


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", benchmark), ("packing", pack)]

#: The first stage's network and the placing of pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
