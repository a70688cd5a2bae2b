"""The bounded timeline ring: newest arrival first, an id is skipped while it is in the ring.

An id may come back after it has left the ring, so neither "first arrival per id" nor "last arrival per
id" is the ring. What comes before a run of 3 * size pairwise different ids (consecutive repeats count
once) does not matter: among the first 2 * size at most ``size`` can be in the unknown earlier ring, so at
least ``size`` are added and push everything older out; the next ``size`` are then all added, and the ring
is exactly those. So the ring is replayed from the latest such run on.

A short tail of the input holds one as a rule. Otherwise all rows are scanned at once, in ranges by arrival:
each range reports where its last run begins, and its first and last different ids, from which the driver
finds runs that reach over borders. Ranges after the latest run whose ids are all in the ring leave it as it
is and are passed over; only the others are replayed, in order.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from orderlens.session import fresh_dir

RING_SIZE = 100
_POSITION, _EXACT = "ring_position", "ring_exact"


def _fold_task(columns: list[str], size: int, start: list[tuple], tail_length: int | None):
    """The task's work. Everything it needs is defined inside, so executors need not have this package."""
    id_at = columns.index("order_id")

    def has_settling_run(ids: list) -> bool:
        """Whether some run of 3 * size ids, consecutive repeats counted once, holds no id twice."""
        last_seen: dict = {}
        begin = at = 0
        previous = object()
        for value in ids:
            if value == previous:
                continue
            previous = value
            begin = max(begin, last_seen.get(value, -1) + 1)
            last_seen[value] = at
            at += 1
            if at - begin >= 3 * size:
                return True
        return False

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ring, ids, seen = deque(start), [], 0
        members = {row[id_at] for row in ring}
        for batch in batches:
            seen += len(batch)
            if tail_length is not None:
                ids.extend(batch["order_id"])
            plain = batch[columns].astype(object).where(batch[columns].notna(), None)
            for row in plain.itertuples(index=False, name=None):
                if row[id_at] in members:
                    continue
                ring.appendleft(row)
                members.add(row[id_at])
                if len(ring) > size:
                    members.discard(ring.pop()[id_at])
        out = pd.DataFrame(list(ring), columns=columns)
        out["ring_position"] = range(1, len(out) + 1)
        # a tail shorter than asked for is the whole input, and so exact as well
        out["ring_exact"] = tail_length is None or seen < tail_length or has_settling_run(ids)
        yield out

    return fold


def _fold(rows: DataFrame, arrival: Sequence[str], size: int, start: list[tuple], tail_length: int | None) -> list:
    """Ring after one bounded stretch of rows, folded in one task; at most ``size`` rows come back."""
    schema = (
        T.StructType(list(rows.schema.fields))
        .add(_POSITION, T.LongType()).add(_EXACT, T.BooleanType())
    )
    task = _fold_task(rows.columns, size, start, tail_length)
    ordered = rows.repartition(1).sortWithinPartitions(*arrival)
    return sorted(ordered.mapInPandas(task, schema).collect(), key=lambda r: r[_POSITION])


def _scan_task(size: int, width: int):
    """Reports one range: its first arrival, rows, different ids (if few), first and last run, and its last settling run.

    A report is flat rows (what, place, order_id, arrival): 9 * size + 3 of them at most.
    """
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = 3 * size
        recent, last_at, at, begin, rows = deque(), {}, 0, 0, 0
        first, settled, opening, opening_ended, ids = None, None, [], False, set()
        for batch in batches:
            rows += len(batch)
            plain = batch.astype(object).where(batch.notna(), None)
            for entry in plain.itertuples(index=False, name=None):
                first = first or entry
                value = entry[0]
                if recent and recent[-1][0] == value:
                    continue
                if len(ids) <= run:
                    ids.add(value)
                seen = last_at.get(value, -1)
                if not opening_ended:
                    if seen >= 0 or len(opening) == run:
                        opening_ended = True
                    else:
                        opening.append(entry)
                begin = max(begin, seen + 1)
                last_at[value] = at
                recent.append(entry)
                at += 1
                if len(recent) > run:
                    gone = recent.popleft()
                    if last_at.get(gone[0]) == at - run - 1:
                        del last_at[gone[0]]
                if at - begin >= run:
                    settled = recent[0]
        if first is None:
            return
        closing = list(recent)[max(0, len(recent) - (at - begin)):]
        report = [("first", rows, first), ("opening" if opening_ended else "whole", 0, first)]
        report += [("settled", 0, settled)] if settled else []
        report += [("enter", k, e) for k, e in enumerate(opening)] + [("leave", k, e) for k, e in enumerate(closing)]
        report += [("id", k, (v, *[None] * width)) for k, v in enumerate(ids)] if len(ids) <= run else []
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        yield pd.DataFrame([(number, what, place, *entry) for what, place, entry in report],
                           columns=["range", "what", "place", "order_id", *[f"at{k}" for k in range(width)]], dtype=object)

    return scan


class _Range:
    """One range's report, in the driver."""

    def __init__(self):
        self.first, self.rows, self.whole, self.settled = None, 0, False, None
        self.enter, self.leave, self.ids = [], [], None


def _scanned(orders: DataFrame, arrival: Sequence[str], size: int) -> list[_Range]:
    """Reports of all ranges by arrival, as many as the session has shuffle partitions."""
    keyed = orders.select("order_id", *[F.col(c).alias(f"at{k}") for k, c in enumerate(arrival)])
    places = [f"at{k}" for k in range(len(arrival))]
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("what", T.StringType()),
                           T.StructField("place", T.LongType()), *keyed.schema.fields])
    count = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(count, *places).sortWithinPartitions(*places)
    found: dict[int, _Range] = {}
    for r in sorted(ranged.mapInPandas(_scan_task(size, len(arrival)), schema).collect(), key=lambda r: (r["range"], r["place"])):
        report = found.setdefault(r["range"], _Range())
        entry = (r["order_id"], tuple(r)[4:])
        if r["what"] == "first":
            report.first, report.rows = entry[1], r["place"]
        elif r["what"] in ("whole", "opening"):
            report.whole = r["what"] == "whole"
        elif r["what"] == "settled":
            report.settled = entry[1]
        elif r["what"] == "id":
            report.ids = (report.ids or set()) | {entry[0]}
        else:
            getattr(report, r["what"]).append(entry)
    return [found[k] for k in sorted(found)]


def _latest_run(ranges: list[_Range], size: int) -> tuple[int, tuple] | None:
    """Range and arrival at which the latest run of 3 * size different ids begins, runs over borders included."""
    latest, window = None, []
    for number, report in enumerate(ranges):
        for value, at in report.enter:
            seen = next((k for k, (v, *_) in enumerate(window) if v == value), None)
            if seen is not None and seen == len(window) - 1:
                continue
            window = window[seen + 1:] if seen is not None else window
            window.append((value, at, number))
            if len(window) >= 3 * size:
                window = window[-3 * size:]
                latest = window[0][2], window[0][1]
        if report.settled is not None:
            latest = number, report.settled
        if not report.whole:
            window = [(value, at, number) for value, at in report.leave]
    return latest


def timeline_ring(orders: DataFrame, arrival: Sequence[str], size: int = RING_SIZE,
                  initial: DataFrame | None = None, tail_rows: int | None = None,
                  chunk_rows: int = 2_000_000) -> DataFrame:
    """The ring after ``orders`` in arrival order, with ``ring_position`` 1 = newest.

    ``initial`` is the ring before these rows (a stream's state), at most ``size`` rows. A tail of ``tail_rows`` is tried
    first; a task replays ``chunk_rows`` rows or one range at a time.
    """
    spark = orders.sparkSession
    descending = [F.col(c).desc() for c in arrival]
    columns = orders.columns
    start: list[tuple] = []
    if initial is not None:
        start = [tuple(r) for r in initial.orderBy(_POSITION).select(*columns).limit(size).collect()]
    length = tail_rows or 10 * size
    # top-k by arrival: each task keeps only its own newest rows
    folded = _fold(orders.orderBy(*descending).limit(length), arrival, size, start, length)
    if folded and not folded[0][_EXACT]:
        folded = _replayed(orders, list(arrival), size, start, chunk_rows)
    if not folded:
        folded = [(*row, i + 1) for i, row in enumerate(start)]
    schema = T.StructType(list(orders.schema.fields)).add(_POSITION, T.LongType())
    return spark.createDataFrame([tuple(r)[: len(columns) + 1] for r in folded], schema)


def _replayed(orders: DataFrame, arrival: list[str], size: int, start: list[tuple], chunk_rows: int) -> list:
    """The ring from the latest settling run on, or from ``start`` where there is none."""
    spark = orders.sparkSession
    ranges = _scanned(orders, arrival, size)
    begin, at = _latest_run(ranges, size) or (0, None)
    ring = start if at is None else []
    # neighbouring ranges are replayed together, up to chunk_rows
    chunks: list[list[int]] = []
    for number in range(begin, len(ranges)):
        if chunks and sum(ranges[k].rows for k in chunks[-1]) + ranges[number].rows <= chunk_rows:
            chunks[-1].append(number)
        else:
            chunks.append([number])
    place = F.struct(*arrival)
    limits = [F.struct(*[F.lit(v).cast(orders.schema[c].dataType).alias(c) for c, v in zip(arrival, ranges[own[0]].first)]) for own in chunks]
    if at is not None:
        limits[0] = F.struct(*[F.lit(v).cast(orders.schema[c].dataType).alias(c) for c, v in zip(arrival, at)])
    rows = orders.filter(place >= limits[0])
    number = F.lit(0)
    for k, limit in enumerate(limits[1:], 1):
        number = F.when(place >= limit, k).otherwise(number)
    if len(chunks) > 1:  # read the input once, however many chunks have to be replayed
        path = fresh_dir(spark, "ring")
        rows.withColumn("ring_chunk", number).repartitionByRange(len(chunks), "ring_chunk", *arrival).write.partitionBy("ring_chunk").parquet(path)
        rows = spark.read.schema(T.StructType([*orders.schema.fields, T.StructField("ring_chunk", T.IntegerType())])).parquet(path)
    folded: list = []
    id_at = orders.columns.index("order_id")
    for k, own in enumerate(chunks):
        reports = [ranges[n] for n in own]
        members = {row[id_at] for row in ring}
        if folded and all(r.ids is not None and r.ids <= members for r in reports):
            continue
        part = rows.filter(F.col("ring_chunk") == k).select(*orders.columns) if len(chunks) > 1 else rows
        got = _fold(part, arrival, size, ring, None)
        if got:
            folded = got
            ring = [tuple(r)[: len(orders.columns)] for r in got]
    return folded


def overlay_status(timeline: DataFrame, changes: DataFrame) -> DataFrame:
    """Timeline with newer statuses laid over it; ``changes`` has order_id and new_status, one per id."""
    newer = changes.select("order_id", "new_status")
    return timeline.join(newer, "order_id", "left").withColumn(
        "status", F.coalesce("new_status", "status")).drop("new_status").select(*timeline.columns)


def unseen_orders(orders: DataFrame, timeline: DataFrame) -> DataFrame:
    """Orders whose id the timeline does not hold yet."""
    return orders.join(timeline.select("order_id").distinct(), "order_id", "left_anti")
