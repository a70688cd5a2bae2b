"""Topics: a Kafka source and sink where the connector is installed, and topic logs as files.

A topic log is a folder per topic, below it one Parquet folder per written batch, with the columns of the
Kafka source (key, value, topic, partition, offset, timestamp). A topic is picked by its path, and the
files are sorted by partition and offset, so both prune by file statistics. Beside it lies a manifest per
batch: the offsets and times of each partition. A reader that starts at an offset, a time or the end finds
there which folders it needs, and the others are never listed or opened.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlens import session
from orderlens.operators.ordering import arrange
from orderlens.schemas import TOPIC_RECORD
from orderlens.session import shuffles_freed, write_whole, written

# fixed values: the topics and their partitions
ORDERS, REGISTRY = "orders", "registry"
PARTITIONS = 3
#: Digits of a batch folder's number.
DIGITS = 12


def kafka_options(servers: str, topics: Sequence[str], starting: str = "earliest",
                  max_records: int | None = None, since_millis: int | None = None) -> dict[str, str]:
    """Options of the Kafka reader: all topics in one subscription, from the start on the first run.

    ``max_records`` bounds a micro-batch (a poll of 500 messages is usual); ``since_millis`` starts at a
    time instead of at ``starting``. A new checkpoint with either is a replay.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "failOnDataLoss": "false",
    }
    if since_millis is None:
        options["startingOffsets"] = starting
    else:
        options["startingTimestamp"] = str(since_millis)
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str], streaming: bool = True, **options) -> DataFrame:
    """Needs the spark-sql-kafka package on the class path. ``options`` as in :func:`kafka_options`."""
    reader = spark.readStream if streaming else spark.read
    return as_records(reader.format("kafka").options(**kafka_options(servers, topics, **options)).load())


def as_records(raw: DataFrame) -> DataFrame:
    """The record envelope: text key and value with topic, partition, offset and time."""
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"), "timestamp",
    )


def write_kafka(messages: DataFrame, servers: str) -> None:
    """messages: key, value, topic."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def partition_of(key: Column, partitions: int = PARTITIONS) -> Column:
    """Topic partition of a key, the same in every engine (first 28 bits of its MD5)."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def assign_offsets(messages: DataFrame, order: Sequence[str], partitions: int = PARTITIONS,
                   segments: int | None = None, key: str = "key") -> DataFrame:
    """Place (key, + order columns, + any others) of one topic: partition by key, dense offsets in order.

    A topic has few partitions, each a hot key by nature; numbering goes through segments.
    """
    placed = messages.withColumn("partition", partition_of(F.col(key), partitions))
    numbered = arrange(placed, "partition", order, segments).with_neighbours([order[0]])
    rows = numbered.rows.withColumn("offset", F.col("rn") - 1)
    return rows.select(*messages.columns, "partition", "offset")


class Placement:
    """The places that :func:`assign_offsets` gives, in passes of about ``pass_rows`` rows, so that no shuffle holds all rows.

    A pass takes a range of the leading column of ``order``; its offsets go on from the number of rows before it. ``rows`` are
    read once a pass, so store them if they are expensive. ``cuts`` are further borders between passes.
    """

    def __init__(self, rows: DataFrame, order: Sequence[str], key: str = "key", cuts: Sequence[int] = (),
                 partitions: int = PARTITIONS, segments: int | None = None, pass_rows: int | None = None):
        self.rows, self.order, self.key, self.partitions, self.segments = rows, list(order), key, partitions, segments
        self.kind = rows.schema[order[0]].dataType
        lead, steps = F.col(order[0]), 200
        # by a number, since only of numbers there are approximate percentiles
        self.place = F.unix_micros(lead) if self.kind.typeName() == "timestamp" else lead
        with shuffles_freed(rows.sparkSession):
            shares = F.percentile_approx(self.place, [n / steps for n in range(1, steps)], 2_000)
            found = rows.agg(F.count("*").alias("n"), shares.alias("shares")).first()
            passes = min(steps, -(-found["n"] // (pass_rows or session.PASS_ROWS)))
            inner = [found["shares"][steps * k // passes - 1] for k in range(1, passes)] if found["shares"] else []
            self.borders = sorted({*inner, *cuts})
            # one row per pass and partition
            counts = rows.groupBy(self._number().alias("pass"), partition_of(F.col(key), partitions).alias("partition")).count().collect()
        self.before: list[dict[int, int]] = [{}]
        for k in range(len(self.borders) + 1):
            ends = dict(self.before[-1])
            for r in counts:
                if r["pass"] == k:
                    ends[r["partition"]] = ends.get(r["partition"], 0) + r["count"]
            self.before.append(ends)

    def _number(self) -> Column:
        """The pass of a row; rows without a time come first, as in the order."""
        return sum((F.coalesce(self.place >= b, F.lit(False)).cast("int") for b in self.borders), F.lit(0))

    @property
    def ends(self) -> dict[int, int]:
        """End offset of every partition."""
        return self.before[-1]

    def parts(self, since: int | None = None, before: int | None = None) -> list[DataFrame]:
        """Frames of the rows with partition and offset, one a pass; ``since`` and ``before`` are values among the cuts.

        Rows without a time have places, but are neither since nor before any time.
        """
        first = 0 if since is None else bisect.bisect_right(self.borders, since)
        last = len(self.borders) if before is None else bisect.bisect_left(self.borders, before)
        parts = [self._part(k) for k in range(first, last + 1)]
        if since is None and before is not None:
            parts[0] = parts[0].filter(self.place.isNotNull())
        return parts

    def _part(self, k: int) -> DataFrame:
        inside = F.lit(True)
        if k > 0:
            inside = inside & (self.place >= self.borders[k - 1])
        if k < len(self.borders):
            inside = inside & F.coalesce(self.place < self.borders[k], F.lit(True))
        placed = assign_offsets(self.rows.filter(inside) if self.borders else self.rows, self.order, self.partitions, self.segments, self.key)
        return shifted(placed, self.before[k])


def shifted(placed: DataFrame, by: dict[int, int]) -> DataFrame:
    """The same messages at later offsets, by so much for each partition."""
    start = F.lit(0).cast("bigint")
    for partition, n in sorted(by.items()):
        start = F.when(F.col("partition") == partition, F.lit(n).cast("bigint")).otherwise(start)
    return placed.withColumn("offset", F.col("offset") + start)


def fan_out(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Every message once per topic."""
    return messages.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics])))


def write_log(records: DataFrame | Sequence[DataFrame], root: str, topic: str, batch: int = 0) -> None:
    """Write one batch of a topic (Kafka columns). A batch that is there in full stays as it is: readers may have seen it.

    The files hold ranges of (partition, offset), so readers of some offsets skip the others by the files' statistics. Several
    frames are written one after the other; readers see the batch when all are there.
    """
    parts = [records] if isinstance(records, DataFrame) else list(records)
    spark = parts[0].sparkSession
    if batch_written(spark, root, topic, batch):
        return
    names = [f.name for f in TOPIC_RECORD]

    def ranged(part: DataFrame):
        return written(part.withColumn("topic", F.lit(topic)).select(*names)
                       .repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset"))

    write_whole(spark, map(ranged, parts), f"{root}/{topic}/{_folder(batch)}")
    # of every partition one row
    listed = read_batch(spark, root, topic, batch).groupBy("partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"), F.count("*").alias("messages"), F.lit(batch).cast("bigint").alias("batch"))
    with shuffles_freed(spark):
        listed.coalesce(1).write.mode("overwrite").parquet(f"{_manifests(root, topic)}/{_folder(batch)}")


def _folder(batch: int) -> str:
    return f"batch-{batch:0{DIGITS}d}"


def _manifests(root: str, topic: str) -> str:
    return f"{root}/manifests/{topic}"


def manifest(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """One row per batch and partition: first and last offset and time, and the number of messages."""
    kind = "partition int, first_offset bigint, last_offset bigint, first_time timestamp, last_time timestamp, messages bigint, batch bigint"
    folder = spark._jvm.org.apache.hadoop.fs.Path(_manifests(root, topic))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(_manifests(root, topic))


def folders_from(batch: int) -> str:
    """A glob of the folder of ``batch`` and all later ones, those to come included."""
    digits = f"{batch:0{DIGITS}d}"
    later = [f"{digits[:k]}[{int(d) + 1}-9]{'?' * (DIGITS - k - 1)}" for k, d in enumerate(digits) if d != "9"]
    return "batch-{" + ",".join([digits, *later]) + "}"


def start_of(spark: SparkSession, root: str, topic: str, offsets: dict[int, int] | None = None,
             since: datetime | None = None, latest: bool = False) -> tuple[int, dict[int, int]]:
    """The first batch folder that a reader needs, and the offset from which it reads each partition.

    ``offsets`` are per partition (others from their start), ``since`` is a time, ``latest`` the end of what is there.
    """
    listed = manifest(spark, root, topic)
    ends = {r["partition"]: r["end"] for r in listed.groupBy("partition").agg((F.max("last_offset") + 1).alias("end")).collect()}
    if latest:
        last = listed.agg(F.max("batch")).first()[0]
        return (0 if last is None else last + 1), ends
    if since is not None:
        needed = listed.filter(F.col("last_time") >= F.lit(since))
        first = {r["partition"]: r["first"] for r in needed.groupBy("partition").agg(F.min("first_offset").alias("first")).collect()}
        offsets = {p: first.get(p, end) for p, end in ends.items()}
    wanted = offsets or {}
    needed = [r["batch"] for r in listed.select("batch", "partition", "last_offset").collect() if r["last_offset"] >= wanted.get(r["partition"], 0)]
    last = listed.agg(F.max("batch")).first()[0]
    return min(needed, default=0 if last is None else last + 1), wanted


def stream_from(spark: SparkSession, root: str, topic: str, offsets: dict[int, int] | None = None,
                since: datetime | None = None, latest: bool = False, max_files: int | None = None) -> DataFrame:
    """A topic's stream from its start, from offsets, from a time or from the end; use it with a new checkpoint."""
    batch, wanted = start_of(spark, root, topic, offsets, since, latest)
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    messages = as_records(reader.parquet(f"{root}/{topic}/{folders_from(batch)}"))
    return replay_from(messages, wanted) if since is None else replay_since(replay_from(messages, wanted), F.lit(since))


def peek_log(spark: SparkSession, root: str, topic: str, n: int, from_beginning: bool = True) -> DataFrame:
    """The first or last n messages of a written topic; only folders that can hold them are read."""
    listed = manifest(spark, root, topic)
    end = listed.agg(F.max("last_offset")).first()[0]
    if end is None:
        return peek(read_log(spark, root, [topic]).limit(0), topic, n, from_beginning)
    # offsets are dense in a partition, so n messages lie within n offsets of the start, or of the furthest end
    inside = (F.col("first_offset") < n) if from_beginning else (F.col("last_offset") > end - n)
    batches = [r["batch"] for r in listed.filter(inside).select("batch").distinct().collect()]
    read = as_records(spark.read.schema(TOPIC_RECORD).parquet(*[f"{root}/{topic}/{_folder(b)}" for b in sorted(batches)]))
    return peek(read.filter((F.col("offset") < n) if from_beginning else (F.col("offset") > end - n)), topic, n, from_beginning)


def batch_written(spark: SparkSession, root: str, topic: str, batch: int) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_manifests(root, topic)}/{_folder(batch)}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _log_paths(root: str, topics: Sequence[str]) -> str:
    return f"{root}/{topics[0]}" if len(topics) == 1 else root + "/{" + ",".join(topics) + "}"


def read_log(spark: SparkSession, root: str, topics: Sequence[str] = (ORDERS,)) -> DataFrame:
    reader = spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    return as_records(reader.parquet(*[f"{root}/{t}" for t in topics]))


def read_batch(spark: SparkSession, root: str, topic: str, batch: int) -> DataFrame:
    return as_records(spark.read.schema(TOPIC_RECORD).parquet(f"{root}/{topic}/{_folder(batch)}"))


def stream_log(spark: SparkSession, root: str, topics: Sequence[str] = (ORDERS,),
               max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return as_records(reader.parquet(_log_paths(root, topics)))


def count_messages(log: DataFrame) -> DataFrame:
    """Messages per topic, as the sum of the partitions' end offsets."""
    return end_offsets(log).groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def end_offsets(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def peek(log: DataFrame, topic: str, n: int, from_beginning: bool = True) -> DataFrame:
    """The first or the last n messages of a topic by offset, ties by partition."""
    messages = log.filter(F.col("topic") == topic)
    order = ["offset", "partition"] if from_beginning else [F.desc("offset"), F.desc("partition")]
    return messages.orderBy(*order).limit(n)


def replay_from(log: DataFrame, starting: dict[int, int]) -> DataFrame:
    """Messages from given offsets on, per partition; partitions not named are read from the start."""
    keep = F.lit(True)
    for partition, offset in starting.items():
        keep = keep & ((F.col("partition") != partition) | (F.col("offset") >= offset))
    return log.filter(keep)


def replay_since(log: DataFrame, since: Column) -> DataFrame:
    """Messages written at or after a time."""
    return log.filter(F.col("timestamp") >= since)


def consumer_lag(log: DataFrame, committed: DataFrame) -> DataFrame:
    """End offset minus committed offset per group and partition; a group that never committed lags by all.

    Both sides have one row per topic partition, after a partial aggregate over the log.
    """
    ends = end_offsets(log)
    topics = committed.select("group", "topic").distinct()
    known = committed.select("group", "topic", "partition", "committed_offset")
    wanted = topics.join(ends, "topic")
    return wanted.join(known, ["group", "topic", "partition"], "left").select(
        "group", "topic", "partition", "end_offset",
        F.coalesce("committed_offset", F.lit(0)).alias("committed_offset"),
        (F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))).alias("lag"),
    )


def route(log: DataFrame) -> dict[str, DataFrame]:
    """Split records by topic; anything unknown becomes an error row."""
    known = F.coalesce(F.col("topic").isin(ORDERS, REGISTRY), F.lit(False))
    return {
        "validate": log.filter(F.col("topic") == ORDERS),
        "register": log.filter(F.col("topic") == REGISTRY),
        "unknown": log.filter(~known).withColumn("error", F.lit("Unknown topic")),
    }
