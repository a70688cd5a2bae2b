"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

#: Setting of a session: the shuffle files of a query go when it has ended, not when the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: About so many rows go through the shuffles of one pass of a large write.
PASS_ROWS = 24_000_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs expect; cluster settings given elsewhere win."""
    builder = (
        SparkSession.builder.appName("orderlens")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the session names none, a local run makes a folder of its own, removes it at exit and remembers it in the
    session, so that one run uses one folder; with any other master that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("orderlens.work.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="orderlens-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("orderlens.work.dir", configured)
    return configured.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind. A DataFrame that is to run twice should not run in here: it would shuffle again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def written(rows: DataFrame) -> DataFrameWriter:
    """A writer whose files are about half as large as by default."""
    return rows.write.option("compression", "zstd")


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def stored(rows: DataFrame | Iterable[DataFrame], path: str) -> Iterator[DataFrame]:
    """The rows as a Parquet folder, which goes at the end: many steps read them, in fewer bytes than a cached table has on disk.

    Several frames, of one schema, are written one after the other.
    """
    parts = iter([rows] if isinstance(rows, DataFrame) else rows)
    head = next(parts)
    spark, schema = head.sparkSession, head.schema
    try:
        write_whole(spark, map(written, chain([head], parts)), path)
        yield spark.read.schema(schema).parquet(path)
    finally:
        remove(spark, path)


def write_whole(spark: SparkSession, parts: Iterable[DataFrameWriter], path: str) -> None:
    """Write one after the other into one folder, each without the shuffle files of those before; the folder appears when all are there."""
    parent, _, name = path.rpartition("/")
    # readers pass over names that begin with a dot
    staging, mode = f"{parent}/.{name}", "overwrite"
    try:
        with shuffles_freed(spark):
            for part in parts:
                part.mode(mode).parquet(staging)
                mode = "append"
    except BaseException:
        remove(spark, staging)
        raise
    remove(spark, path)
    source, target = map(spark._jvm.org.apache.hadoop.fs.Path, (staging, path))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"{staging} could not be renamed to {path}")
