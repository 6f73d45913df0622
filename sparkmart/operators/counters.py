"""Row counters of a job, observed while it runs (no pass of their own)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Named points of one plan; each counts the rows that pass it, and those for which a condition holds."""

    def __init__(self) -> None:
        self.points: dict[str, Observation] = {}

    def at(self, df: DataFrame, point: str, **conditions: Column) -> DataFrame:
        self.points[point] = Observation()
        sums = [F.sum(F.when(c, 1).otherwise(0)).alias(name) for name, c in conditions.items()]
        return df.observe(self.points[point], F.count(F.lit(1)).alias("n"), *sums)

    def value(self, point: str, name: str = "n") -> int:
        """After the plan has run."""
        return int(self.points[point].get[name] or 0)


def watched(counters: Counters | None, df: DataFrame, point: str, **conditions: Column) -> DataFrame:
    return df if counters is None else counters.at(df, point, **conditions)
