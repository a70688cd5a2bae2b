"""Stored tables: a change log per table, read back as "latest row per key".

Every batch writes its changed rows to ``<root>/<table>/changes/batch_id=N``, replacing what an earlier
attempt at batch N left. A replayed batch reads only what batches before it wrote, so it gives the same
result again. Every ``snapshot_every`` batches the whole table is written once, which bounds how many
change folders a reader needs. Tables that only grow are not rewritten whole; of them every
``snapshot_every`` neighbouring batches become one run, as many runs one larger run, and so on.

Within each folder the rows of a large table lie in ``buckets`` folders by a hash of the key, sorted by
key, with a bloom filter. A look-up of one key, or a micro-batch, opens the buckets of its keys only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from orderlens import session
from orderlens.schemas import TABLES, TableSpec
from orderlens.session import shuffles_freed, write_whole, written

FOLDER = "period"

TOPIC_OFFSETS = TableSpec(
    "topic_offsets",
    StructType([StructField("topic", TABLES["orders"].schema["order_id"].dataType),
                StructField("partition", TABLES["orders"].schema["quantity"].dataType),
                StructField("end_offset", LongType())]),
    ("topic", "partition"),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; epoch milliseconds become timestamps."""
    def fitted(field):
        have = df.schema[field.name].dataType
        column = F.col(field.name)
        if field.dataType.typeName() == "timestamp" and isinstance(have, LongType):
            return F.timestamp_millis(column).alias(field.name)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[fitted(f) for f in schema])


def latest_by_key(changes: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Latest row per key; copies of a key collapse on the map side."""
    rest = [c for c in changes.columns if c not in keys and c != newest]
    if not rest:
        return changes.select(*keys).distinct()
    picked = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("picked"))
    return picked.select(*keys, "picked.*")


BUCKET = "bucket"
BUCKETS = 16


class ViewStore:
    """Tables below one root folder, written batch by batch.

    ``buckets`` is fixed for the life of a store; choose it so that a bucket of the largest table fits a few tasks.
    """

    def __init__(self, spark: SparkSession, root: str, snapshot_every: int = 20,
                 tables: dict[str, TableSpec] | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.snapshot_every = snapshot_every
        self.buckets = buckets
        self.tables = {**TABLES, TOPIC_OFFSETS.name: TOPIC_OFFSETS, **(tables or {})}

    def _changes(self, table: str) -> str:
        return f"{self.root}/{table}/changes"

    def _snapshot(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/snapshots/{batch_id}"

    def _runs(self, table: str) -> str:
        return f"{self.root}/{table}/runs"

    def bucket_of(self, table: str, key: Column) -> Column:
        """The bucket of a key; of a literal key it is a literal too, so that a scan is cut to one folder."""
        spec = self.tables[table]
        return F.pmod(F.xxhash64(key.cast(spec.schema[spec.bucket_by].dataType)), F.lit(self.buckets)).cast("int")

    def _save(self, table: str, rows: DataFrame, path: str) -> None:
        with shuffles_freed(rows.sparkSession):
            self._writer(table, rows).mode("overwrite").parquet(path)

    def _writer(self, table: str, rows: DataFrame) -> DataFrameWriter:
        spec = self.tables[table]
        if spec.bucket_by is None:
            return written(rows)
        # the rebalance gives a bucket one file, or several where it is too large for one task
        dealt = (
            rows.withColumn(BUCKET, self.bucket_of(table, F.col(spec.bucket_by)))
            .hint("rebalance", BUCKET)
            .sortWithinPartitions(BUCKET, spec.bucket_by, *[k for k in spec.keys if k != spec.bucket_by])
        )
        # a filter that is not sized by the keys of its file takes 1 MB
        return written(dealt).partitionBy(BUCKET).option(f"parquet.bloom.filter.enabled#{spec.bucket_by}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true")

    def _load(self, table: str, paths: Sequence[str], base: str, *, numbered: bool) -> DataFrame:
        spec = self.tables[table]
        extra = [StructField("batch_id", LongType())] if numbered else []
        if spec.bucket_by is not None:
            extra.append(StructField(BUCKET, IntegerType()))
        read = self.spark.read.schema(StructType([*spec.schema, *extra])).option("basePath", base).parquet(*paths)
        return read if spec.bucket_by is not None else read.withColumn(BUCKET, F.lit(0))

    def write(self, table: str, batch_id: int, rows: DataFrame) -> None:
        """Upsert: the rows of batch ``batch_id``, one per key."""
        self._save(table, conform(rows, self.tables[table].schema), f"{self._changes(table)}/batch_id={batch_id}")
        self._written(table, batch_id)

    def write_folded(self, table: str, batch_id: int, rows: DataFrame, fold: Callable[[DataFrame], DataFrame],
                     pass_rows: int | None = None) -> None:
        """Upsert of ``fold(rows)``, which must make a key's rows from that key's rows alone. Of more than ``pass_rows`` rows some
        buckets are folded after the others, so that no shuffle holds all rows; ``rows`` are read once a pass."""
        spec = self.tables[table]
        parts = (self._writer(table, conform(part, spec.schema)) for part in self.passes(table, rows, fold, pass_rows))
        write_whole(rows.sparkSession, parts, f"{self._changes(table)}/batch_id={batch_id}")
        self._written(table, batch_id)

    def passes(self, table: str, rows: DataFrame, fold: Callable[[DataFrame], DataFrame], pass_rows: int | None = None) -> Iterator[DataFrame]:
        """``fold`` of all rows or, where they are many, of the rows of some buckets after the others."""
        with shuffles_freed(rows.sparkSession):
            count = min(self.buckets, -(-rows.count() // (pass_rows or session.PASS_ROWS)))
        if count <= 1:
            yield fold(rows)
            return
        part = F.pmod(self.bucket_of(table, F.col(self.tables[table].bucket_by)), F.lit(count))
        for k in range(count):
            yield fold(rows.filter(part == k))

    def _written(self, table: str, batch_id: int) -> None:
        spec = self.tables[table]
        if batch_id > 0 and batch_id % self.snapshot_every == 0 and not spec.grows:
            self._save(table, self._with_changes(table, batch_id), self._snapshot(table, batch_id))
        if spec.grows:
            self._compact(table, batch_id)

    def _compact(self, table: str, batch_id: int) -> None:
        """Merge the last snapshot_every folders (batches, or runs of the level below) into one, as the binary counter goes."""
        span = self.snapshot_every
        while span > 1 and (batch_id + 1) % span == 0:
            first = batch_id + 1 - span
            pieces = self._pieces(table, first, batch_id, below=span)
            if pieces is None:
                return
            self._save(table, pieces.drop(BUCKET), f"{self._runs(table)}/{first}-{batch_id}")
            span *= self.snapshot_every

    def _pieces(self, table: str, first: int, last: int, below: int | None = None) -> DataFrame | None:
        """All changes of batches first to last, from the longest complete runs (shorter than ``below``) and single batches."""
        spec = self.tables[table]
        runs: dict[int, list[int]] = {}
        if spec.grows:
            for name in self._complete_names(self._runs(table)):
                a, b = map(int, name.split("-"))
                if b <= last and (below is None or b - a + 1 < below):
                    runs.setdefault(a, []).append(b)
        whole, single, at = [], [], first
        for batch in self._complete(self._changes(table), "batch_id="):
            if at <= batch <= last:
                for a in range(at, batch + 1):  # a run may begin with batches that wrote nothing here
                    if a in runs and max(runs[a]) >= batch:
                        whole.append(f"{self._runs(table)}/{a}-{max(runs[a])}")
                        at = max(runs[a]) + 1
                        break
                else:
                    single.append(f"{self._changes(table)}/batch_id={batch}")
                    at = batch + 1
        parts = [self._load(table, single, self._changes(table), numbered=True)] if single else []
        parts += [self._load(table, [path], path, numbered=True) for path in whole]
        out = None
        for part in parts:
            out = part if out is None else out.unionByName(part)
        return out

    def _with_changes(self, table: str, upto: int, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """State after batch ``upto``, from the last snapshot before it and the changes since; ``only`` picks rows by key or bucket."""
        spec = self.tables[table]
        base = -1 if spec.grows else max((n for n in self._complete(f"{self.root}/{table}/snapshots", "") if n < upto), default=-1)
        changes = self._pieces(table, base + 1, upto)
        if base >= 0:
            path = self._snapshot(table, base)
            stored = self._load(table, [path], path, numbered=False).withColumn("batch_id", F.lit(base).cast("bigint"))
            changes = stored if changes is None else changes.unionByName(stored)
        if changes is None:
            return self.empty(table)
        if only is not None:
            changes = only(changes)
        return latest_by_key(changes.drop(BUCKET), spec.keys, "batch_id").select(*spec.schema.names)

    def lookup(self, table: str, value, upto: int | None = None) -> DataFrame:
        """The current rows of one key, from its bucket alone; a table without buckets is scanned (it is small)."""
        spec = self.tables[table]
        last = self.last_batch(table) if upto is None else upto
        if last is None:
            return self.empty(table)
        key = spec.bucket_by or spec.keys[0]
        wanted = F.col(key) == F.lit(value).cast(spec.schema[key].dataType)
        if spec.bucket_by is not None:
            wanted = (F.col(BUCKET) == self.bucket_of(table, F.lit(value))) & wanted
        return self._with_changes(table, last, lambda rows: rows.filter(wanted))

    def touched(self, table: str, batch_id: int, rows: DataFrame) -> DataFrame:
        """The stored rows before batch ``batch_id`` whose key is in ``rows``: their buckets are opened, and a semi join below the
        "latest per key" shuffles only those rows."""
        if batch_id == 0:
            return self.empty(table)
        return self._matching(table, batch_id - 1, rows)

    def lookup_many(self, table: str, rows: DataFrame) -> DataFrame:
        """The current rows of all keys in ``rows``."""
        last = self.last_batch(table)
        return self.empty(table) if last is None else self._matching(table, last, rows)

    def _matching(self, table: str, upto: int, rows: DataFrame) -> DataFrame:
        key = self.tables[table].bucket_by
        keys = rows.select(F.col(key).cast(self.tables[table].schema[key].dataType).alias(key)).distinct()
        # at most as many numbers as there are buckets
        with shuffles_freed(rows.sparkSession):
            opened = [r[0] for r in keys.select(self.bucket_of(table, F.col(key))).distinct().collect()]
        return self._with_changes(table, upto, lambda stored: stored.filter(F.col(BUCKET).isin(opened)).join(keys, key, "left_semi"))

    def before(self, table: str, batch_id: int) -> DataFrame:
        """State before batch ``batch_id``."""
        if batch_id == 0:
            return self.empty(table)
        return self._with_changes(table, batch_id - 1)

    def after(self, table: str, batch_id: int) -> DataFrame:
        return self._with_changes(table, batch_id)

    def current(self, table: str) -> DataFrame:
        """State after the last complete batch."""
        last = self.last_batch(table)
        return self.empty(table) if last is None else self._with_changes(table, last)

    def forget_before_snapshot(self, table: str) -> int:
        """Delete the change folders that the last snapshot covers, and older snapshots; returns how many changes went.

        The snapshot and the changes after it give the same state. A state before that snapshot cannot be read any more.
        """
        snapshots = self._complete(f"{self.root}/{table}/snapshots", "")
        last = self.last_batch(table)
        usable = [n for n in snapshots if last is not None and n < last]
        if not usable:
            return 0
        name = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = [self._snapshot(table, n) for n in usable[:-1]]
        old = [f"{self._changes(table)}/batch_id={n}" for n in self._complete(self._changes(table), "batch_id=") if n <= usable[-1]]
        for path in map(name, gone + old):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(old)

    def changes(self, table: str) -> DataFrame:
        """Every change ever written, with its batch."""
        return self._load(table, [self._changes(table)], self._changes(table), numbered=True).drop(BUCKET)

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], self.tables[table].schema)

    def last_batch(self, table: str) -> int | None:
        """Largest batch whose write has completed."""
        return max(self._complete(self._changes(table), "batch_id="), default=None)

    def _complete(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the folders below one whose write has completed, in order."""
        numbers = [n.removeprefix(prefix) for n in self._complete_names(folder) if n.startswith(prefix)]
        return sorted(int(n) for n in numbers if n.isdigit())

    def _complete_names(self, folder: str) -> list[str]:
        name = self.spark._jvm.org.apache.hadoop.fs.Path
        path = name(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return [n for n in names if fs.exists(name(f"{folder}/{n}/_SUCCESS"))]

    def first_batch(self, checkpoint: str) -> int:
        """The number in this store of a checkpoint's batch 0: after all that is stored when the checkpoint is first used.

        It is written into the checkpoint's folder, so a restarted query goes on with the same numbers, and a new checkpoint
        on an existing store adds to its state instead of replacing its first batches.
        """
        path = f"{checkpoint.rstrip('/')}/first_batch"
        if "first_batch_v1" not in self._complete_names(checkpoint.rstrip("/")):
            first = 1 + max((n for t in self.tables for n in self._complete(self._changes(t), "batch_id=")), default=-1)
            self.spark.range(first, first + 1).coalesce(1).write.parquet(f"{path}_v1")
        return self.spark.read.parquet(f"{path}_v1").first()["id"]

    def bootstrap(self, batch_id: int = 0) -> None:
        """Create every table, empty."""
        for name in self.tables:
            self.write(name, batch_id, self.empty(name))


def write_by_time(rows: DataFrame, path: str, time: str = "timestamp", order_id: str = "order_id",
                  grain: str = "month") -> None:
    """Rows in one folder per month (or other grain that the caller names), in time order within a file.

    The rebalance gives each folder few files, and splits a folder too large for one task by the shuffle's
    map outputs, which works for copies of one row too.
    """
    instant = F.timestamp_millis(time) if isinstance(rows.schema[time].dataType, LongType) else F.col(time)
    folder = F.date_trunc(grain, instant).cast("date")
    (
        rows.withColumn(FOLDER, folder)
        .hint("rebalance", FOLDER)
        .sortWithinPartitions(FOLDER, time, order_id)
        .write.mode("overwrite").partitionBy(FOLDER)
        .option("parquet.bloom.filter.enabled#order_id", "true")
        .parquet(path)
    )


def read_by_time(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)
