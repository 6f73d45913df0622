"""Date parsing and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, strip
from .vocab import MONTHS_FR

# Tried in order, each with its separator; single letters accept one or two digits, like strptime.
DATE_FORMATS = {"d/M/yyyy": "/", "yyyy-M-d": "-", "d-M-yyyy": "-"}
FREE_TEXT = r"(?iU)([A-Za-zÀ-ÿ]+)\s+(\d{4})"


def _month_map() -> Column:
    return F.create_map(*[x for k, v in MONTHS_FR.items() for x in (F.lit(k), F.lit(v))])


def parse_date(c) -> Column:
    """Multi-format date parse; typed dates/timestamps pass through.

    ``d/m/Y``, ``Y-m-d``, ``d-m-Y``, then free text "<month word> <year>"
    (first match) -> first day of that month.  Anything else -> NULL.
    """
    v = strip(col_(c).cast("string"))
    word = F.lower(F.regexp_extract(v, FREE_TEXT, 1))
    year = F.regexp_extract(v, FREE_TEXT, 2)
    month = _month_map()[word]
    free = F.when(
        (year != "") & month.isNotNull() & (year != "0000"),
        F.try_to_date(F.concat_ws("-", year, month.cast("string"), F.lit("1")), "yyyy-M-d"),
    )
    # a text without the format's separator cannot match it, and a failed parse costs many times a successful one
    tries = [F.when(v.contains(sep), F.try_to_date(v, fmt)) for fmt, sep in DATE_FORMATS.items()]
    return F.coalesce(*tries, free)
