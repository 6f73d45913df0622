"""Numeric and money expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, strip

NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MONEY = "decimal(38,2)"


def safe_number(c) -> Column:
    """Text -> double; anything that is not a plain number becomes NULL."""
    s = strip(col_(c).cast("string"))
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def integral(c) -> Column:
    """A double -> bigint only when it holds a whole number, else NULL."""
    x = col_(c)
    return F.when(x == F.floor(x), x.cast("bigint"))


def round_even(c, digits: int = 0) -> Column:
    """Banker's rounding (Spark ``round`` rounds half up)."""
    return F.bround(col_(c), digits)


def to_money_int(c) -> Column:
    """Round half-even to a whole unit and cast to bigint."""
    return F.bround(col_(c), 0).cast("bigint")


def clip_round(c) -> Column:
    """Clip at zero, round half-even to an integer."""
    return F.bround(F.greatest(col_(c), F.lit(0.0)), 0).cast("bigint")


def cents(c) -> Column:
    """A 2-decimal double amount as exact integer cents."""
    return F.round(col_(c) * 100).cast("bigint")


def idiv(num, den) -> Column:
    """Exact division of two bigints, truncating toward zero (SQL ``div``)."""
    return F.call_function("div", col_(num).cast("bigint"), col_(den).cast("bigint"))


def div_round_half_up(num, den) -> Column:
    """Exact half-up rounding of num/den for non-negative integers."""
    return idiv(col_(num) * 2 + col_(den), col_(den) * 2)


def round_half_up(c, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` on doubles.

    Plain IEEE operations, so any engine given the same double returns the
    same bits (``round`` implementations differ near ties between engines).
    """
    x = col_(c)
    k = float(10 ** digits)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(
        F.floor(x * k + 0.5).cast("double") / k)
