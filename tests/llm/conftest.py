import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents():
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


@pytest.fixture(scope="session")
def make(spark):
    """A documents-like frame of (doc_id, text) with extra columns that carry the operators' internal names."""

    def frame(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t), n, "x", 7) for n, (i, t) in enumerate(rows)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, _id int, _key string, piece int"
        return spark.createDataFrame(full, schema).repartition(parts)

    return frame


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty, white space only, repeated rows, repeated ids, a long text, ties."""
    return [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (None, "null id here a@b.c"), (3, ""),
            (4, " \n\t "), (5, "word " * 30_000), (6, "one two three four five six"), (6, "another text under the same id"), (None, None),
            (7, "Éé ÀB 日本 \U0001f600 ok"), (8, "x" * 50_000)]
