"""Order-dependent work per key, the same at every size and for every key.

Several folds need "the previous row of this key in arrival order". The plain form is a window partitioned by the key,
which puts every row of one key in one task. Here all rows are cut into segments by ranges of (key, arrival, tie-break).
The borders between segments come from a bounded sample, as a scalar subquery of the same plan, so nothing runs while the
DataFrame is built; each row finds its segment by binary search, and one exchange deals the rows out by segment. Windows then
run per (segment, key) without a further exchange.

A key that reaches over a border is named by that border, so which rows belong to such keys is known per row. For those alone
the state before each segment comes from a table with one row per segment and such key (two keys per segment at most), which
is read from the same exchange and broadcast.

The tie-break is a hash of the row and the number of the task that made it: the same when a lost executor's work is
repeated, and different for exact copies from different tasks, so that a border can pass between copies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

SEGMENT, TIE, BORDER = "_segment", "_tie", "_border"
#: Sampled rows per segment, and in all.
SAMPLE_EACH, SAMPLE_MOST = 16, 100_000


@dataclass
class Arranged:
    """Rows cut into segments, ready for per-key ordered work; they carry SEGMENT, TIE and BORDER."""

    rows: DataFrame
    key: str
    order: list[str]

    @property
    def window(self):
        # BORDER follows from the other two; as part of the key it lets a filter on it pass below the window
        return Window.partitionBy(SEGMENT, self.key, BORDER).orderBy(*self.order, TIE)

    @property
    def order_struct(self) -> Column:
        return F.struct(*self.order, TIE)

    def with_rows(self, rows: DataFrame) -> Arranged:
        return Arranged(rows, self.key, self.order)

    def plain(self) -> DataFrame:
        return self.rows.drop(SEGMENT, TIE, BORDER)

    def _carried(self, local: DataFrame, carry: DataFrame) -> DataFrame:
        """Rows with what comes before their segment; carry has a row for each segment of each border key."""
        carry = carry.withColumnsRenamed({self.key: "_carry_key", SEGMENT: "_carry_segment"})
        same = F.col(self.key).eqNullSafe(F.col("_carry_key")) & (F.col(SEGMENT) == F.col("_carry_segment"))
        return local.join(F.broadcast(carry), same & F.col(BORDER), "left").drop("_carry_key", "_carry_segment")

    def _of_border_keys(self, *summary: Column) -> DataFrame:
        """One row per segment and border key, in one partition: at most two for each segment."""
        return self.rows.filter(BORDER).groupBy(SEGMENT, self.key).agg(*summary).repartition(1)

    def with_neighbours(self, columns: Sequence[str], first: Sequence[str] = ()) -> Arranged:
        """Adds rn (position from 1), and structs prev and head: the previous row of the key, and the columns ``first`` of its first row.

        Every row carries both structs, so ask for what is needed of them only.
        """
        packed, opening, whole = F.struct(*columns), F.struct(*(first or columns)), F.struct(*self.rows.columns)
        w = self.window
        local = self.rows.withColumns({
            "rn": F.row_number().over(w).cast("bigint"),
            "prev": F.lag(packed).over(w),
            "head": F.first(opening).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        })
        # whole rows, so that this reads the same columns, and with them the same exchange, as what comes of the rows
        summary = self._of_border_keys(
            F.count("*").alias("n"),
            F.min_by(whole, self.order_struct).alias("first_row"),
            F.max_by(whole, self.order_struct).alias("last_row"),
        )

        def part(row: str, names: Sequence[str]) -> Column:
            return F.when(F.col(row).isNotNull(), F.struct(*[F.col(row)[c].alias(c) for c in names]))

        across = Window.partitionBy(self.key).orderBy(SEGMENT)
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.select(
            self.key, SEGMENT,
            F.lag(part("last_row", columns)).over(across).alias("carry_prev"),
            F.first(part("first_row", first or columns)).over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("carry_head"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carry_rows"),
        )
        joined = self._carried(local, carry).withColumns({
            "prev": F.when(F.col("rn") == 1, F.col("carry_prev")).otherwise(F.col("prev")),
            "head": F.coalesce("carry_head", "head"),
            "rn": F.col("rn") + F.coalesce("carry_rows", F.lit(0)),
        }).drop("carry_prev", "carry_head", "carry_rows")
        return self.with_rows(joined)

    def with_running_sum(self, name: str, amount: Column) -> Arranged:
        """Adds the sum of ``amount`` over the rows of the key up to and including this one."""
        local = self.rows.withColumn(name, F.sum(amount).over(self.window.rowsBetween(Window.unboundedPreceding, 0)))
        sums = self._of_border_keys(F.sum(amount).alias("part"))
        before = Window.partitionBy(self.key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        carry = sums.select(self.key, SEGMENT, F.sum("part").over(before).alias("carry_sum"))
        joined = self._carried(local, carry)
        return self.with_rows(joined.withColumn(name, F.col(name) + F.coalesce("carry_sum", F.lit(0))).drop("carry_sum"))


def _borders(places: DataFrame, segments: int) -> Column:
    """The first place of every segment but the first, from the sample: a sorted array, as a scalar subquery."""
    most = min(SAMPLE_MOST, max(segments, SAMPLE_EACH * segments))
    # the smallest hashes are a random sample of a bounded size; each task keeps its own smallest
    sample = places.orderBy(F.xxhash64(f"place.{TIE}", F.lit("sample"))).limit(most)
    in_order = sample.agg(F.sort_array(F.collect_list("place")).alias("places"))
    picked = F.expr(f"transform(sequence(1, {segments - 1}), i -> places[int(i * size(places) div {segments})])")
    return in_order.select(F.when(F.size("places") > 0, picked).otherwise(F.col("places")).alias("borders")).scalar()


def arrange(df: DataFrame, key: str, order: Sequence[str], segments: int | None = None) -> Arranged:
    """Prepare ``df`` for ordered work per ``key``, in as many segments as the session has shuffle partitions."""
    count = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(TIE, F.struct(F.xxhash64(*df.columns).alias("row"), F.spark_partition_id().alias("task")))
    place = F.struct(key, *[c for c in order if c != key], TIE)
    if count == 1:
        return Arranged(tied.repartition(1).withColumns({SEGMENT: F.lit(0), BORDER: F.lit(False)}), key, list(order))
    borders = _borders(tied.select(place.alias("place")), count)
    steps = [1 << bit for bit in reversed(range((count - 1).bit_length()))]
    search = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(F.get("_borders", at + step - 1) <= F.col("_place"), at + step).otherwise(at))
    # the borders on both sides of a segment name the keys that may go on beyond it
    named = [F.coalesce(F.get("_borders", F.col(SEGMENT) + at)[key].eqNullSafe(F.col(key)), F.lit(False))
             & F.get("_borders", F.col(SEGMENT) + at).isNotNull() for at in (-1, 0)]
    placed = (
        tied.withColumns({"_place": place, "_borders": borders})
        .withColumn(SEGMENT, search)
        .withColumn(BORDER, named[0] | named[1])
        .drop("_place", "_borders")
    )
    rows = placed.repartition(segments, SEGMENT) if segments else placed.repartition(SEGMENT)
    # not deterministic, so that filters on it stay above the exchange, and all that is made of the rows reads one exchange
    rows = rows.withColumn(BORDER, F.col(BORDER) & (F.monotonically_increasing_id() >= 0))
    return Arranged(rows, key, list(order))


def group_in_chunks(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int = 10_000,
                    segments: int | None = None) -> DataFrame:
    """Rows grouped by key into arrays of at most ``chunk_rows`` rows, in order.

    A key with few rows gives one array, chunk 0. A larger one continues in further chunks, so that no
    row of the result holds an unbounded group and no row is dropped.
    """
    items = [c for c in df.columns if c != key]
    placed = arrange(df, key, order, segments).with_neighbours(list(order))
    chunk = F.floor((F.col("rn") - 1) / F.lit(chunk_rows)).cast("bigint")
    gathered = (
        placed.rows.withColumn("chunk", chunk)
        .groupBy(key, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("rn", *items))).alias("packed"))
    )
    return gathered.select(
        key, "chunk", F.size("packed").cast("bigint").alias("row_count"),
        F.transform("packed", lambda r: r.dropFields("rn")).alias("items"),
    )
