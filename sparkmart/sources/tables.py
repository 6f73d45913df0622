"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .store import _fs

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan; naming the columns keeps ``ReadSchema`` to what is used.

    The number of partitions follows the files' row groups and
    ``spark.sql.files.maxPartitionBytes`` alone, whatever the number of cores.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


#: Bytes of files whose rows one task sorts or groups, and the number of tasks below which the session's setting will do.
TASK_BYTES, FEW_TASKS = 2 << 20, 8


def tasks_for(spark: SparkSession, path: str) -> int | None:
    """How many tasks to deal a table's rows over, so that what one task holds does not grow with the table (None: few)."""
    fs, p, _ = _fs(spark, path)
    n = -(-fs.getContentSummary(p).getLength() // TASK_BYTES)
    return n if n > FEW_TASKS else None
