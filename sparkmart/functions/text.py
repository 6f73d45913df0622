"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import NULL_TOKENS, SLUG_FROM, SLUG_TO, WHITESPACE


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every kind of whitespace (Spark's ``trim`` strips spaces only).

    ``btrim`` with an explicit character set: no regular expression, so it
    stays a cheap per-row scan inside generated code.
    """
    return F.btrim(col_(c), F.lit(WHITESPACE))


def clean_text(c) -> Column:
    """Strip, then fold the text spellings of "missing" to NULL."""
    s = strip(c)
    return F.when(s.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(s)


def text_or_nan(c) -> Column:
    """Strip; a NULL becomes the text ``nan`` (reproduces a string cast)."""
    return F.coalesce(strip(c), F.lit("nan"))


def lower_key(c) -> Column:
    """Case-insensitive key of a name."""
    return F.lower(strip(c))


def is_all_upper(c) -> Column:
    """True when the text has cased letters and all of them are upper case."""
    x = col_(c)
    return F.coalesce((x == F.upper(x)) & (x != F.lower(x)), F.lit(False))


def slugify(c) -> Column:
    """ASCII slug of an accented label: ``Maintenance informatique`` -> ``maintenance_informatique``."""
    s = F.translate(F.lower(strip(c)), SLUG_FROM, SLUG_TO)
    s = F.regexp_replace(s, "[^a-z0-9]+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")
