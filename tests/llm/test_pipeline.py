import re

import corpus_pipeline as pipeline
import pytest
from sparkmart.llm import langid
from sparkmart.llm._common import held_out, read, stored

from . import test_line_dedup as line_test
from . import test_minhash as near_test
from .test_decontaminate import brute as hits


@pytest.fixture(scope="module")
def kept(spark, sf):
    out = [read(spark, sf, "documents")]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf), f"test-{name}"))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(kept):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(d.columns == kept[0].columns for d in kept[:5])


def test_language_keeps_clean_documents(spark, kept):
    net = langid.fit(kept[0].where(~held_out()))
    want = {r.doc_id for r in langid.with_language(kept[0], net).collect() if r.lang_pred != "und" and r.score >= 1 / 3}
    assert {i for i, _ in rows(kept[1])} == want and len(want) > 0.99 * kept[0].count()


def test_line_dedup_on_its_input(kept):
    before = rows(kept[1])
    want = line_test.brute(before)
    assert dict(rows(kept[2])) == {i: want[i, t] for i, t in before if want[i, t] or not t}


def test_one_document_of_each_group(kept):
    want = {x[2] for x in near_test.brute(rows(kept[2]), 5, 80)}
    assert {i for i, _ in rows(kept[3])} == want


def test_no_benchmark_passage_is_left(spark, sf, kept):
    items = [tuple(r) for r in read(spark, sf, "benchmark").select("item_id", "text").collect()]
    assert {i for i, _ in rows(kept[4])} == {x[0] for x in hits(rows(kept[3]), items) if not x[2]}
    assert kept[4].count() < kept[3].count()


def test_packing_holds_every_document(kept):
    assert {r.doc_id for r in kept[5].select("doc_id").distinct().collect()} == {i for i, _ in rows(kept[4])}
    full = kept[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in full) <= 2048


def test_stages_handle_odd_and_empty_tables(spark, sf, make, odd):
    for table in (make(odd), make([])):
        docs = table
        for name, stage in pipeline.STAGES:
            out = stored(stage(spark, docs, sf), f"odd-{name}")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        assert docs.count() == 0 or not [t for _, t in rows(docs) if t is None or not re.search(r"\w", t)]
