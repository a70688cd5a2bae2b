"""Materialized views over gated orders: customers, products, processing metrics.

``arrival`` is the list of columns that orders the events; its first column is the leading time. The
folds of the event-at-a-time model are expressed as a neighbour look-up plus aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlens.functions.scalars import average, money_sum
from orderlens.functions.specs import order_spec
from orderlens.operators.ordering import SEGMENT, Arranged, arrange
from orderlens.schemas import ACCEPTED, MONEY, ORDER_COLUMNS

# arrival of rows read from a topic
TOPIC_ARRIVAL = ["arrival_time", "partition", "offset"]


def gated(df: DataFrame) -> DataFrame:
    return df.filter(order_spec().valid())


def _customer_columns(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """What the customer view reads; hot rows are written to disk, so nothing else should come along."""
    return orders.select(*dict.fromkeys(["customer_id", "order_id", "timestamp", "total", *arrival]))


def repeat_guard(orders: DataFrame, arrival: Sequence[str], segments: int | None = None) -> Arranged:
    """Adds ``kept``: false iff the order id equals that of the customer's previous arriving order."""
    placed = arrange(orders, "customer_id", arrival, segments).with_neighbours(["order_id"])
    repeated = F.coalesce(F.col("prev.order_id").eqNullSafe(F.col("order_id")) & F.col("prev").isNotNull(),
                          F.lit(False))
    return placed.with_rows(placed.rows.withColumn("kept", ~repeated))


def _cents_and_rest(amount: Column) -> tuple[Column, Column]:
    """Money as cents-exact decimals, and what is too large for them as doubles; both can be added in any order of partitions."""
    cents = amount.try_cast(MONEY)
    return cents, F.when(cents.isNull(), amount)


def _customers_reduced(orders: DataFrame, arrival: Sequence[str], segments: int | None = None) -> DataFrame:
    """One row per customer: head (the first order), and more, spent, latest and last_order_id of the orders kept after it.

    A segment gives one row per customer, in which only its first order is undecided: whether it is kept depends on the last
    order of the segment before. So rows are dealt out once, and what meets per customer are at most as many rows as
    segments.
    """
    placed = arrange(_customer_columns(orders, arrival), "customer_id", arrival, segments)
    w = placed.window
    local = placed.rows.withColumns({"rn": F.row_number().over(w), "before": F.lag("order_id").over(w)})
    later = (F.col("rn") > 1) & ~F.col("before").eqNullSafe(F.col("order_id"))
    seen = F.struct("order_id", "timestamp", "total")
    cents, rest = _cents_and_rest(F.col("total"))
    parts = local.groupBy(SEGMENT, "customer_id").agg(
        F.count_if(later).alias("more"),
        F.sum(F.when(later, cents)).alias("cents"), F.sum(F.when(later, rest)).alias("rest"),
        F.min_by(seen, placed.order_struct).alias("head"),
        F.max_by(seen, F.when(later, placed.order_struct)).alias("latest"),
        F.max_by("order_id", placed.order_struct).alias("last_order_id"),
    )
    across = Window.partitionBy("customer_id").orderBy(SEGMENT)
    joined = parts.withColumns({"nth": F.row_number().over(across), "before": F.lag("last_order_id").over(across)})
    kept = (F.col("nth") > 1) & ~F.col("before").eqNullSafe(F.col("head.order_id"))
    cents, rest = _cents_and_rest(F.col("head.total"))
    latest = F.coalesce("latest", F.when(kept, F.col("head")))
    none = F.lit(0).cast(MONEY)

    def spent(with_head: Column) -> Column:
        exact = F.sum(F.coalesce("cents", none) + F.coalesce(F.when(with_head, cents), none))
        return exact.cast("double") + F.sum(F.coalesce("rest", F.lit(0.0)) + F.coalesce(F.when(with_head, rest), F.lit(0.0)))

    return joined.groupBy("customer_id").agg(
        (F.sum("more") + F.count_if(kept)).alias("more"),
        spent(kept).alias("spent"), spent(kept | (F.col("nth") == 1)).alias("spent_with_head"),
        F.min_by("head", SEGMENT).alias("head"),
        F.max_by(latest, F.when(latest.isNotNull(), F.col(SEGMENT))).alias("latest"),
        F.max_by("last_order_id", SEGMENT).alias("last_order_id"),
    )


def customer_stats(orders: DataFrame, arrival: Sequence[str], segments: int | None = None) -> DataFrame:
    """Per-customer statistics; "last" and "first" follow arrival, not the largest timestamp."""
    reduced = _customers_reduced(orders, arrival, segments)
    latest = F.coalesce("latest", "head")
    return reduced.select(
        "customer_id", (F.col("more") + 1).alias("total_orders"), F.col("spent_with_head").alias("total_spent"),
        latest["order_id"].alias("last_order_id"), latest["timestamp"].alias("last_order_timestamp"),
        F.col("head.timestamp").alias("first_order_timestamp"),
    )


def customer_totals(orders: DataFrame, arrival: Sequence[str], segments: int | None = None) -> DataFrame:
    """Only the counters of the customer view, for rankings and global sums."""
    return customer_stats(orders, arrival, segments).select("customer_id", "total_orders", "total_spent")


def last_time(arrival: Sequence[str], time: str = "timestamp") -> Column:
    """Time of the last arrival. A time that leads the arrival order needs only a maximum."""
    if arrival[0] == time:
        return F.max(time)
    return F.max_by(time, F.struct(*arrival))


def product_stats(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Per-product statistics over every row, repeats included; one partial and one final hash aggregate."""
    grouped = orders.groupBy("product_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
        money_sum("total").alias("total_revenue"),
        F.count("*").alias("order_count"),
        last_time(arrival).alias("last_order_timestamp"),
    )
    return grouped.select(
        "product_id", "total_quantity", "total_revenue", "order_count",
        average("total_quantity", "order_count").alias("avg_quantity"), "last_order_timestamp",
    )


def accepted_revenue() -> Column:
    return money_sum(F.when(F.col("status") == ACCEPTED, F.col("total")))


def processing_stats(decoded: DataFrame, processor_id: str) -> DataFrame:
    """One row: processed (valid, repeats included), errors (undecodable or gate failures), accepted revenue.

    ``decoded`` may carry a boolean ``decode_error``; without it every row counts as decoded.
    """
    bad = F.col("decode_error") if "decode_error" in decoded.columns else F.lit(False)
    flagged = decoded.withColumn("ok", order_spec().valid() & ~bad)
    return flagged.agg(
        F.count_if("ok").alias("processed_count"),
        F.count_if(~F.col("ok")).alias("error_count"),
        money_sum(F.when(F.col("ok") & (F.col("status") == ACCEPTED), F.col("total")))
        .alias("total_revenue_accepted"),
        F.max(F.when(F.col("ok"), F.col("timestamp"))).alias("last_processed_timestamp"),
    ).select(F.lit(processor_id).alias("processor_id"), "*")


def timeline_entries(orders: DataFrame, *extra: str) -> DataFrame:
    """The eight order fields only (and any ordering columns asked for)."""
    return orders.select(*ORDER_COLUMNS, *[c for c in extra if c not in ORDER_COLUMNS])


def first_arrival_per_order(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Opt-in global de-duplication: the first arriving row of every order id."""
    return _one_per_order(orders, F.min_by, arrival)


def last_arrival_per_order(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Orders keyed by id, last write wins."""
    return _one_per_order(orders, F.max_by, arrival)


def _one_per_order(orders: DataFrame, pick, arrival: Sequence[str]) -> DataFrame:
    # an aggregate, not a row_number window: copies of one id collapse on the map side
    rest = [c for c in orders.columns if c != "order_id"]
    chosen = orders.groupBy("order_id").agg(pick(F.struct(*rest), F.struct(*arrival)).alias("chosen"))
    return chosen.select("order_id", "chosen.*").select(*orders.columns)


def stored_timeline(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """The full timeline table: keyed by (time, id), the last arrival of a key wins."""
    rest = [c for c in orders.columns if c not in ("timestamp", "order_id")]
    chosen = orders.groupBy("timestamp", "order_id").agg(
        F.max_by(F.struct(*rest), F.struct(*arrival)).alias("chosen"))
    return chosen.select("timestamp", "order_id", "chosen.*").select(*orders.columns)


def view_sizes(customers: DataFrame, products: DataFrame, timeline: DataFrame,
               processing: DataFrame) -> DataFrame:
    """Sizes of the views and the metrics in one row, without joining the views to each other."""
    return merge_single_rows([
        customers.agg(F.count("*").alias("customer_count")),
        products.agg(F.count("*").alias("product_count")),
        timeline.agg(F.count("*").alias("timeline_size")),
        processing.select("processed_count", "error_count"),
    ])


def merge_single_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Put the columns of several one-row results into one row."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    columns = [c for part in parts for c in part.columns]
    return stacked.agg(*[F.max(c).alias(c) for c in columns])


def all_views(orders: DataFrame, arrival: Sequence[str], ring: DataFrame, processor_id: str,
              segments: int | None = None) -> dict[str, DataFrame]:
    """The four views of one decoded input."""
    valid = gated(orders)
    return {
        "customers": customer_stats(valid, arrival, segments),
        "products": product_stats(valid, arrival),
        "timeline": ring,
        "processing": processing_stats(orders, processor_id),
    }


def views_as_rows(views: dict[str, DataFrame]) -> DataFrame:
    """All views stacked in one long table (view, key, row_count, amount, last_timestamp)."""
    customers = views["customers"].select(
        F.lit("customers").alias("view"), F.col("customer_id").cast("string").alias("key"),
        F.col("total_orders").alias("row_count"), F.col("total_spent").alias("amount"),
        F.col("last_order_timestamp").alias("last_timestamp"))
    products = views["products"].select(
        F.lit("products").alias("view"), F.col("product_id").alias("key"),
        F.col("order_count").alias("row_count"), F.col("total_revenue").alias("amount"),
        F.col("last_order_timestamp").alias("last_timestamp"))
    timeline = views["timeline"].select(
        F.lit("timeline").alias("view"), F.col("order_id").alias("key"),
        F.lit(1).cast("bigint").alias("row_count"), F.col("total").alias("amount"),
        F.col("timestamp").alias("last_timestamp"))
    processing = views["processing"].select(
        F.lit("processing").alias("view"), F.col("processor_id").alias("key"),
        F.col("processed_count").alias("row_count"), F.col("total_revenue_accepted").alias("amount"),
        F.col("last_processed_timestamp").alias("last_timestamp"))
    return customers.unionByName(products).unionByName(timeline).unionByName(processing)


def zero_rows(keys: DataFrame, key: str, stats: DataFrame, zeros: dict) -> DataFrame:
    """Every key with its statistics, zeroed where it has none yet."""
    return keys.join(stats, key, "left").select(
        key, *[F.coalesce(F.col(c), F.lit(v).cast(stats.schema[c].dataType)).alias(c)
               for c, v in zeros.items()]
    )


def _cents(amount: Column) -> Column:
    """Doubles added to cents again, where cents can be told apart at all."""
    return F.when(F.abs(amount) < 1e13, F.round(amount, 2)).otherwise(amount)


def fold_customers(orders: DataFrame, arrival: Sequence[str], state: DataFrame,
                   segments: int | None = None) -> DataFrame:
    """Customer statistics after ``orders`` on top of the stored ``state``; one row per customer in ``orders``.

    Only the first order of a customer in the batch depends on the stored last order id, so the batch is
    reduced to one row per customer before it meets the state.
    """
    reduced = _customers_reduced(orders, arrival, segments)
    old = state.select("customer_id", F.struct(*[c for c in state.columns if c != "customer_id"]).alias("old"))
    merged = reduced.join(old, "customer_id", "left")
    keep_head = ~F.coalesce(F.col("old.last_order_id") == F.col("head.order_id"), F.lit(False))
    last = F.coalesce("latest", F.when(keep_head, F.col("head")))
    return merged.select(
        "customer_id",
        (F.coalesce("old.total_orders", F.lit(0)) + F.col("more") + keep_head.cast("int")).cast("bigint")
        .alias("total_orders"),
        _cents(F.coalesce("old.total_spent", F.lit(0.0)) + F.col("spent")
               + F.when(keep_head, F.col("head.total")).otherwise(0.0)).alias("total_spent"),
        F.coalesce(last["order_id"], F.col("old.last_order_id")).alias("last_order_id"),
        F.coalesce(last["timestamp"], F.col("old.last_order_timestamp")).alias("last_order_timestamp"),
        F.coalesce("old.first_order_timestamp", "head.timestamp").alias("first_order_timestamp"),
    )


def fold_products(orders: DataFrame, arrival: Sequence[str], state: DataFrame) -> DataFrame:
    """Product statistics after ``orders`` on top of ``state``; one row per product in ``orders``."""
    fresh = product_stats(orders, arrival)
    old = state.select("product_id", F.struct(*[c for c in state.columns if c != "product_id"]).alias("old"))
    merged = fresh.join(old, "product_id", "left").select(
        "product_id",
        (F.coalesce("old.total_quantity", F.lit(0)) + F.col("total_quantity")).alias("total_quantity"),
        _cents(F.coalesce("old.total_revenue", F.lit(0.0)) + F.col("total_revenue")).alias("total_revenue"),
        (F.coalesce("old.order_count", F.lit(0)) + F.col("order_count")).alias("order_count"),
        "last_order_timestamp",
    )
    return merged.withColumn("avg_quantity", average("total_quantity", "order_count"))


def fold_counters(fresh: DataFrame, state: DataFrame, key: str, sums: Sequence[str], latest: str) -> DataFrame:
    """Add one-row counters to the stored ones; amounts of money stay cents-exact."""
    columns = [key, *sums, latest]
    both = fresh.select(*columns).unionByName(state.select(*columns))
    kinds = {f.name: f.dataType.typeName() for f in state.schema}
    added = {c: _cents(F.sum(c)) if kinds[c] == "double" else F.sum(c) for c in sums}
    return both.groupBy(key).agg(*[a.alias(c) for c, a in added.items()], F.max(latest).alias(latest))
