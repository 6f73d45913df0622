"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC dates, ANSI errors, AQE re-planning
# (partition coalescing and skew-join splitting), no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # wide projections compile to large methods; let the JIT compile them
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparkmart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` is read from the session; only where it is unset and
    every task runs inside this process (local tests) is a temporary folder made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="sparkmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name or 'work'}-{uuid.uuid4().hex[:12]}"


#: Spark's setting by which a statement's shuffle files go when it ends, and how many blocks hold it on (with the value to restore).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_holding: dict[int, list] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each statement that runs inside deletes its shuffle files when it ends.

    Else they stay until the driver happens to collect its garbage, and a job of many
    steps has those of all steps on disk at once.  The session's setting is restored.
    """
    key = id(spark._jsparkSession)
    with _lock:
        held = _holding.setdefault(key, [0, spark.conf.get(_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _holding[key]
                if held[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, held[1])


#: Applications that have the package already.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that Python workers can import it.

    Operators that run Python inside tasks call it; once per application it
    zips the package's source files and hands them to Spark's own file
    distribution.  Nothing depends on the workers' current folder or PYTHONPATH.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="sparkmart-ship-")) / "sparkmart.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
