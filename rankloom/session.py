"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange:
    # a hot user or item must not pin a join to one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A task that writes few folders (the three parts of a split) need not sort its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "3",
}

#: Bytes of a shuffle that a task reads at most, as adaptive execution joins partitions. Rows of a few numbers take some ten bytes
#: there and several hundred in a hash table, so the default of 64 MB would fill a task with gigabytes.
READ_BYTES = 16 << 20


def build_session(master: str = "local[*]", app: str = "rankloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on and make checkpoints possible."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    read = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(read)) > READ_BYTES:
        spark.conf.set(read, f"{READ_BYTES}b")
    shared_dir(spark)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Kernels are pickled by reference, so a worker must be able to import them wherever it runs.
    """
    context = spark.sparkContext
    if getattr(context, "_rankloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="rankloom-package-"), "rankloom_package.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    context._rankloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-"))
    return context.getCheckpointDir()


_SCOPES: list[str] = []
_LOCK = threading.Lock()
#: What ``dropped_shuffles`` found set, a value per loop that runs.
_LOOPS: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediates made inside go when the block ends; write what must stay elsewhere before that."""
    root = f"{shared_dir(spark).rstrip('/')}/rankloom/scope-{uuid.uuid4().hex}"
    _SCOPES.append(root)
    try:
        yield root
    finally:
        _SCOPES.remove(root)
        remove(spark, root)


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ran inside go when it ends; otherwise those of every round stay until the driver collects garbage.

    For loops whose rounds write tables: no DataFrame should run twice inside. The setting is the session's, so of loops that run
    side by side the first sets it and the last puts it back.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _LOCK:
        _LOOPS.append(spark.conf.get(name, "false"))
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _LOCK:
            before = _LOOPS[0]
            _LOOPS.pop()
            if not _LOOPS:
                spark.conf.set(name, before)


def side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Any]]) -> list[Any]:
    """Results of calls that each run Spark jobs; the jobs of one fill the cores that those of another leave idle."""
    if not calls:
        return []
    with ThreadPoolExecutor(len(calls)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, whatever file system it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared store has this file or folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, or below the innermost ``scratch``."""
    root = _SCOPES[-1] if _SCOPES else f"{shared_dir(spark).rstrip('/')}/rankloom"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back: several readers, one computation."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
