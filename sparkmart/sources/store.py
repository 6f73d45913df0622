"""Sinks: raw archive, versioned publish (single parts are replaced by ``versions``).

Tables live on the shared file system (HDFS / object store / local in tests).  A
full replace writes a *new* version folder and then adds one numbered, immutable
manifest that names it, so readers never see half-written or missing tables and a
failed job leaves the previous version in place.  File-system calls go through
Hadoop's ``FileSystem`` of the session, never through the driver's local disk.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shuffles_removed

MANIFESTS = "_manifests"
#: Codec of stored tables: keys and numbers as text take a third less than with Spark's default.
CODEC = "zstd"


def archive_frame(raw: DataFrame, stamp: bool = True) -> DataFrame:
    """Raw archive layout: lower-case column names, optional load stamp."""
    df = raw.toDF(*[c.strip().lower() for c in raw.columns])
    return df.withColumn("charge_le", F.current_timestamp()) if stamp else df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p, _ = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _number(name: str) -> int:
    return int(name.removesuffix(".json"))


def commit(spark: SparkSession, root: str, content: dict, number: int | None = None) -> int:
    """Add the next manifest (or manifest ``number``) of ``root``: a complete file under its final name at once.

    Manifests are never changed; readers take the one with the highest number, so
    a table set switches in one step and is there at every moment.
    """
    folder = f"{root}/{MANIFESTS}"
    fs, p, jvm = _fs(spark, folder)
    fs.mkdirs(p)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/_tmp-{uuid.uuid4().hex}.json")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(content).encode("utf-8")))
    out.close()
    n = number if number is not None else max(map(_number, _manifests(spark, root)), default=-1) + 1
    while True:
        to = jvm.org.apache.hadoop.fs.Path(f"{folder}/{n:012d}.json")
        if not fs.exists(to) and fs.rename(tmp, to):
            return n
        if number is not None:  # somebody has committed it: theirs counts
            fs.delete(tmp, False)
            return n
        n += 1


def _manifests(spark: SparkSession, root: str) -> list[str]:
    return [x for x in _names(spark, f"{root}/{MANIFESTS}") if x.endswith(".json")]


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The current manifest of ``root`` (None before the first)."""
    names = _manifests(spark, root)
    if not names:
        return None
    fs, p, jvm = _fs(spark, f"{root}/{MANIFESTS}/{names[-1]}")
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    line = reader.readLine()
    reader.close()
    return {"number": _number(names[-1])} | json.loads(line)


def publish_all(tables: dict[str, DataFrame], root: str, version: str | None = None,
                partition_by: dict[str, list[str]] | None = None,
                check: Callable[[dict[str, DataFrame], str], dict] | None = None,
                counters: Callable[[dict[str, DataFrame]], dict] | None = None) -> str:
    """Write all tables as one new version, then commit one manifest for the set.

    ``check`` gets the staged tables and a folder for rows that break its rules; if it raises nothing is
    published and the former version stays.  What it and ``counters`` (of the staged tables) return goes
    into the manifest.
    """
    version = version or uuid.uuid4().hex[:16]
    spark, schemas = next(iter(tables.values())).sparkSession, {}
    with shuffles_removed(spark):
        for name, df in tables.items():
            w = df.write.mode("overwrite").option("compression", CODEC)
            if (partition_by or {}).get(name):
                w = w.partitionBy(*partition_by[name])
            w.parquet(f"{root}/v={version}/{name}")
            schemas[name] = df.schema.json()
        staged = {n: spark.read.schema(StructType.fromJson(json.loads(s))).parquet(f"{root}/v={version}/{n}") for n, s in schemas.items()}
        extra = {"checks": check(staged, f"{root}/_quarantine/v={version}")} if check else {}
        if counters:
            extra["counters"] = counters(staged)
    commit(spark, root, {"version": version, "schemas": schemas, **extra})
    return version


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the current version of ``root``."""
    m = manifest(spark, root)
    if m is None:
        raise FileNotFoundError(f"no published version under {root}")
    schema = StructType.fromJson(json.loads(m["schemas"][name]))
    return spark.read.schema(schema).parquet(f"{root}/v={m['version']}/{name}").select(*schema.names)


def folder(spark: SparkSession, root: str, name: str) -> str:
    """Where one table of the current version of ``root`` lies."""
    return f"{root}/v={current_version(spark, root)}/{name}"


def retain(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` published versions; the deleted versions' names."""
    names, gone = _manifests(spark, root), []
    for old in names[:-keep]:
        fs, p, jvm = _fs(spark, f"{root}/{MANIFESTS}/{old}")
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        version = json.loads(reader.readLine())["version"]
        reader.close()
        fs.delete(p, False)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={version}"), True)
        gone.append(version)
    return gone


def publish(df: DataFrame, table_root: str, version: str | None = None,
            partition_by: list[str] | None = None) -> str:
    """Publish a single table."""
    return publish_all({"data": df}, table_root, version, {"data": partition_by or []})


def current_version(spark: SparkSession, table_root: str) -> str | None:
    m = manifest(spark, table_root)
    return m and m["version"]


def read_current(spark: SparkSession, table_root: str) -> DataFrame:
    return read_published(spark, table_root, "data")


def write_raw_archive(raw: dict[str, DataFrame], root: str) -> str:
    """Full replace of all raw tables as one version; every anomaly is kept as text."""
    return publish_all({name: archive_frame(df) for name, df in raw.items()}, root)
