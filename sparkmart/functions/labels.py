"""Canonicalisation of closed-vocabulary labels.

The alias tables are tiny literals, so they are inlined as a ``map`` literal
(no join, stays inside whole-stage codegen).  For a large alias table use
:func:`normalise_with_table`, a left join that the planner can broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_, strip
from .vocab import CITY_CANONICAL, CITY_VARIANTS, SERVICE_ALIASES, STATUS_ALIASES


def _lit_map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def normalise_alias(c, aliases: dict) -> Column:
    """Alias on the trimmed lower-case key; unknown -> trimmed input; NULL stays NULL."""
    s = strip(c)
    return F.coalesce(_lit_map(aliases)[F.lower(s)], s)


def normalise_service(c) -> Column:
    return normalise_alias(c, SERVICE_ALIASES)


def normalise_status(c) -> Column:
    return normalise_alias(c, STATUS_ALIASES)


def normalise_city(c) -> Column:
    s = strip(c)
    return F.when(F.lower(s).isin(CITY_VARIANTS), F.lit(CITY_CANONICAL)).otherwise(s)
