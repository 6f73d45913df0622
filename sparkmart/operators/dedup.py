"""Keep-one-per-key operators.

All use ``row_number() == 1`` over a keyed window.  Spark plans this as a
``WindowGroupLimit`` *before* the shuffle, so every map task forwards at most
one candidate per key: a hot key holding a third of the rows costs one row
per map task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_all_upper, lower_key


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order`` (NULL keys form one group, as in pandas)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*key_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_case_insensitive(df: DataFrame, name: str, order: Sequence[str | Column] = ("seq",),
                           prefix: Sequence[str | Column] = ()) -> DataFrame:
    """One row per lower-cased name; mixed case preferred over ALL CAPS.

    ``prefix`` columns sort before the case flag (e.g. a source rank).
    """
    key = lower_key(name)
    o = [*prefix, is_all_upper(F.col(name)).asc(), *order]
    return keep_first(df, [key], o)
