"""The mart's constraints as a gate: all rules over a staged table set in one job, before it is published.

A rule is about one table: a column that is never null, no longer than n, one of some
values, a key that is unique, or a key that another table has.  :func:`violations` counts
the offending rows of all rules; row rules of a table share one pass, each key adds one
grouping of its own rows and of those that refer to it.  :func:`enforce`
refuses a set with violations, after writing the offending rows with the rules they break.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lower_key


@dataclass(frozen=True)
class Rule:
    """``kind``: not_null, length (``limit``), domain (``values``), unique (of ``columns``), foreign (to ``parent``.``key``)."""

    table: str
    columns: tuple[str, ...]
    kind: str
    limit: int = 0
    values: tuple[str, ...] = ()
    parent: str = ""
    key: str = ""
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.table}.{','.join(self.columns)}:{self.kind}"


class ConstraintViolation(ValueError):
    """A table set was not published; ``counts`` has the offending rows by rule, ``quarantine`` where they are."""

    def __init__(self, counts: dict[str, int], quarantine: str):
        super().__init__(f"not published: {counts}; offending rows in {quarantine}")
        self.counts, self.quarantine = counts, quarantine


def _keys(rule: Rule) -> list[Column]:
    return [lower_key(c) if rule.any_case else F.col(c) for c in rule.columns]


def _row_rule(rule: Rule) -> Column | None:
    c = F.col(rule.columns[0])
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "length":
        return F.length(c) > rule.limit
    if rule.kind == "domain":
        return c.isNotNull() & ~c.isin(*rule.values)
    return None


def _marked(tables: dict[str, DataFrame], table: str, rules: list[Rule]) -> tuple[DataFrame, list[tuple[Rule, Column]]]:
    """The table with what its rules need joined to it, and whether a row breaks each."""
    df, tests = tables[table], []
    for i, rule in enumerate(r for r in rules if r.table == table):
        broken = _row_rule(rule)
        if rule.kind == "foreign":
            parent = tables[rule.parent].select(F.col(rule.key).alias(f"_key{i}")).where(F.col(f"_key{i}").isNotNull()).distinct().withColumn(f"_has{i}", F.lit(True))
            df = df.join(parent, F.col(rule.columns[0]) == F.col(f"_key{i}"), "left")
            broken = F.col(rule.columns[0]).isNotNull() & F.col(f"_has{i}").isNull()
        elif rule.kind == "unique":
            keys = [k.alias(f"_u{i}_{n}") for n, k in enumerate(_keys(rule))]
            many = tables[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n").withColumn(f"_many{i}", F.lit(True))
            same = [k.eqNullSafe(F.col(f"_u{i}_{n}")) for n, k in enumerate(_keys(rule))]
            cond = same[0]
            for x in same[1:]:
                cond = cond & x
            df = df.join(many, cond, "left")
            broken = F.col(f"_many{i}").isNotNull()
        tests.append((rule, F.coalesce(broken, F.lit(False))))
    return df, tests


def _key_counts(tables: dict[str, DataFrame], rules: list[Rule]) -> list[DataFrame]:
    """(rule, n) of the rules about keys: one grouping for each key, of its own rows and those that refer to it.

    Only keys and counts are exchanged, not the rows they stand in.
    """
    groups: dict[tuple, list[Rule]] = {}
    for r in rules:
        if r.kind in ("unique", "foreign"):
            groups.setdefault((r.table, r.columns, r.any_case) if r.kind == "unique" else (r.parent, (r.key,), False), []).append(r)
    out = []
    for (table, columns, any_case), about in groups.items():
        foreign = [r for r in about if r.kind == "foreign"]
        counts = ["_own", *[f"_of{i}" for i in range(len(foreign))]]
        one = lambda n: [F.lit(1 if c == n else 0).cast("bigint").alias(c) for c in counts]
        keys = [lower_key(c) if any_case else F.col(c) for c in columns]
        held = tables[table].select(*[k.alias(f"_{n}") for n, k in enumerate(keys)], *one("_own"))
        for i, r in enumerate(foreign):
            held = held.unionByName(tables[r.table].where(F.col(r.columns[0]).isNotNull()).select(F.col(r.columns[0]).alias("_0"), *one(f"_of{i}")))
        by_key = held.groupBy(*[f"_{n}" for n in range(len(keys))]).agg(*[F.sum(c).alias(c) for c in counts])
        lost = {r.name: F.when(F.col("_own") == 0, F.col(f"_of{i}")) for i, r in enumerate(foreign)}
        broken = [(r.name, lost.get(r.name, F.greatest(F.col("_own") - 1, F.lit(0)))) for r in about]
        sums = by_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(f"_{i}") for i, (_, n) in enumerate(broken)])
        out.append(sums.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("n")) for i, (name, _) in enumerate(broken)]))))
    return out


def violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(rule, n) of every rule: offending rows, of a unique key the rows beyond each key's first."""
    out = []
    for table in dict.fromkeys(r.table for r in rules):
        tests = [(r.name, F.coalesce(_row_rule(r), F.lit(False))) for r in rules if r.table == table and r.kind not in ("unique", "foreign")]
        if tests:
            sums = tables[table].agg(*[F.coalesce(F.sum(t.cast("long")), F.lit(0)).cast("bigint").alias(f"_{i}") for i, (_, t) in enumerate(tests)])
            out.append(sums.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("n")) for i, (name, _) in enumerate(tests)]))))
    out += _key_counts(tables, rules)
    all_ = out[0]
    for more in out[1:]:
        all_ = all_.unionByName(more)
    return all_


def offending(tables: dict[str, DataFrame], table: str, rules: list[Rule]) -> DataFrame:
    """The rows of one table that break one of ``rules``, and ``broken``, the names of these rules."""
    df, tests = _marked(tables, table, rules)
    broken = F.array_compact(F.array(*[F.when(t, F.lit(r.name)) for r, t in tests]))
    return df.select(*tables[table].columns, broken.alias("broken")).where(F.size("broken") > 0)


def enforce(tables: dict[str, DataFrame], rules: list[Rule], quarantine: str, reported: frozenset[str] = frozenset()) -> dict[str, int]:
    """Counts of all rules (a few dozen numbers); raises where a rule not in ``reported`` is broken."""
    counts = {r["rule"]: r["n"] for r in violations(tables, rules).collect()}
    refused = {k: n for k, n in counts.items() if n and k not in reported}
    if refused:
        broken = [r for r in rules if r.name in refused]
        for table in dict.fromkeys(r.table for r in broken):
            offending(tables, table, broken).write.parquet(f"{quarantine}/{table}")
        raise ConstraintViolation(refused, quarantine)
    return counts
