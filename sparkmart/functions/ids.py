"""Deterministic keys.

Surrogate keys are ``md5`` of the normalised natural key: computed row by row,
so no global numbering task, and stable across re-runs and replays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, lower_key


def surrogate_key(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[col_(p).cast("string") for p in parts]))


def name_key(c) -> Column:
    """Surrogate key of a case-insensitive name."""
    return F.md5(lower_key(c))


def hash_seq(*parts) -> Column:
    """A 60-bit integer from the md5 of the parts (a deterministic arrival order)."""
    h = F.substring(surrogate_key(*parts), 1, 15)
    return F.conv(h, 16, 10).cast("bigint")


def invoice_key(event_key) -> Column:
    """The invoice's key: the whole hash of the event key, so that replays are idempotent and keys do not collide."""
    return F.md5(col_(event_key).cast("string"))


def invoice_number(order_date, event_key) -> Column:
    """``FAC-<year>-<8 hex>``: for display only, as 32 bits are not unique."""
    return F.concat(
        F.lit("FAC-"), F.year(col_(order_date)).cast("string"), F.lit("-"),
        F.upper(F.substring(F.md5(col_(event_key).cast("string")), 1, 8)),
    )
