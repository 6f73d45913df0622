"""Helpers shared by the training-data operators: inputs, stored tables, Arrow text buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    A folder of our own is made only where ``spark.checkpoint.dir`` is unset
    and every task runs inside this process (``local[...]``, as in tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = tempfile.mkdtemp(prefix="sparkmart-llm-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: what was computed survives the loss of any executor, and
    later steps read the columns they need instead of computing them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for own columns that ``df`` does not have."""
    has, out = {c.lower() for c in df.columns}, []
    for n in names:
        while f"_{n}" in has:
            n = f"_{n}"
        out.append(f"_{n}")
    return out


def same_document(id_col: str, text_col: str, id_: str, key: str) -> Column:
    """Whether a row has the id ``id_`` (null or not) and a text with the hash ``key``."""
    return F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(text_col) == F.col(key))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_hash(*cols: str) -> Column:
    """A fixed pseudo-random order over rows, for bounded samples."""
    return F.xxhash64(F.lit(20240607), *[F.col(c) for c in cols])


def thinned(df: DataFrame, by: str, order: str, want: dict, counts: dict) -> DataFrame:
    """Rows of each value of ``by`` whose hash ``order`` is small: at least about ``want`` of its ``counts`` rows.

    Before a ranking for a bounded sample this leaves about as many rows as the
    sample needs, however many tasks read the table.
    """
    top = 1 << 30
    some = []
    for value, k in want.items():
        share = min(1.0, (1.3 * k + 100) / max(counts.get(value, 0), 1))
        some.append((F.col(by) == value) & (F.pmod(F.col(order), F.lit(top)) < int(share * top)))
    while len(some) > 1:  # in pairs, as a chain of many values would nest as deep
        some = [a | b for a, b in zip(some[::2], some[1::2])] + some[len(some) - len(some) % 2:]
    return df.where(some[0] if some else F.lit(False))


def held_out(col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id's text leaves 2 on division by 4 (a null id is in no fold)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a string array, without copying; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, offs, data = arr.buffers()
    n = len(arr)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0]:o[-1]], o - o[0]


def runs(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes each (a longer row comes alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
