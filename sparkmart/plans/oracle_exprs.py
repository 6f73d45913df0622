"""DuckDB twins of the scalar functions (``sparkmart.functions``)."""

from __future__ import annotations

from ..functions.money import NUMERIC_TEXT
from ..functions.vocab import (CITY_CANONICAL, CITY_VARIANTS, MONTHS_FR, NULL_TOKENS,
                               SERVICE_ALIASES, SLUG_FROM, SLUG_TO, STATUS_ALIASES,
                               WHITESPACE_CODEPOINTS)
from .oracle_feeds import q

FREE_TEXT = r"(?i)([A-Za-zÀ-ÿ]+)\s+(\d{4})"


_WS = " || ".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS)


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def clean_text(x: str) -> str:
    s = strip(x)
    toks = ", ".join(q(t) for t in NULL_TOKENS)
    return f"(CASE WHEN {s} IN ({toks}) THEN NULL ELSE {s} END)"


def text_or_nan(x: str) -> str:
    return f"COALESCE({strip(x)}, 'nan')"


def parse_date(x: str) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    word = f"lower(regexp_extract({s}, '{FREE_TEXT}', 1))"
    year = f"regexp_extract({s}, '{FREE_TEXT}', 2)"
    month = "(CASE " + " ".join(f"WHEN {word} = {q(k)} THEN {v}" for k, v in MONTHS_FR.items()) + " END)"
    free = (f"(CASE WHEN {year} <> '' AND {year} <> '0000' AND {month} IS NOT NULL "
            f"THEN make_date(CAST({year} AS INTEGER), {month}, 1) END)")
    tries = ", ".join(f"CAST(try_strptime({s}, '{f}') AS DATE)" for f in ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y"))
    return f"COALESCE({tries}, {free})"


def norm_alias(x: str, aliases: dict) -> str:
    s = strip(x)
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in aliases.items())
    return f"COALESCE(CASE lower({s}) {arms} END, {s})"


def norm_service(x: str) -> str:
    return norm_alias(x, SERVICE_ALIASES)


def norm_status(x: str) -> str:
    return norm_alias(x, STATUS_ALIASES)


def norm_city(x: str) -> str:
    s = strip(x)
    vs = ", ".join(q(v) for v in CITY_VARIANTS)
    return f"(CASE WHEN lower({s}) IN ({vs}) THEN {q(CITY_CANONICAL)} ELSE {s} END)"


def safe_number(x: str) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    pat = NUMERIC_TEXT.lstrip("^").rstrip("$")
    return f"(CASE WHEN regexp_full_match({s}, '{pat}') THEN TRY_CAST({s} AS DOUBLE) END)"


def integral(x: str) -> str:
    return f"(CASE WHEN {x} = floor({x}) THEN CAST({x} AS BIGINT) END)"


def money_int(x: str) -> str:
    return f"CAST(round_even(round_even({x}, 2), 0) AS BIGINT)"


def is_upper(x: str) -> str:
    return f"COALESCE({x} = upper({x}) AND {x} <> lower({x}), false)"


def lower_key(x: str) -> str:
    return f"lower({strip(x)})"


def name_key(x: str) -> str:
    return f"md5({lower_key(x)})"


def slugify(x: str) -> str:
    s = f"translate(lower({strip(x)}), '{SLUG_FROM}', '{SLUG_TO}')"
    s = f"regexp_replace({s}, '[^a-z0-9]+', '_', 'g')"
    return f"regexp_replace({s}, '^_+|_+$', '', 'g')"
