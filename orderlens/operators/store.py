"""Produced orders: construction, store statistics, rankings by count, upsert by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.functions.scalars import average, money_sum, now_millis, round_half_up
from orderlens.functions.specs import Spec, split_rows, strict_order_spec
from orderlens.operators.monitor import top
from orderlens.operators.views import last_time
from orderlens.schemas import MONEY, PENDING


def new_orders(requests: DataFrame, order_id: Column | None = None, at: Column | None = None,
               spec: Spec | None = None) -> tuple[DataFrame, DataFrame]:
    """Build orders from (customer_id, product_id, quantity, unit_price, status): (orders, rejects).

    The total uses the price as given, before it is rounded to cents.
    """
    price = F.col("unit_price").cast("double")
    built = requests.select(
        (F.uuid() if order_id is None else order_id).alias("order_id"),
        "customer_id", "product_id", "quantity",
        round_half_up(price, 2).alias("unit_price"),
        round_half_up(F.col("quantity") * price, 2).alias("total"),
        (now_millis() if at is None else at).alias("timestamp"),
        F.coalesce(F.col("status"), F.lit(PENDING)).alias("status"),
    )
    return split_rows(built, spec or strict_order_spec())


def order_summary() -> Column:
    """One readable line per order."""
    return F.format_string(
        "Order %s: Customer %d ordered %d x %s @ $%.2f = $%.2f [%s]",
        F.substring("order_id", 1, 8), F.col("customer_id"), F.col("quantity"), F.col("product_id"),
        F.col("unit_price"), F.col("total"), F.col("status"),
    )


def raw_rows(orders: DataFrame, spec: Spec | None = None) -> DataFrame:
    """Rows of the raw orders table: decimals and timestamps, only orders that satisfy the strict spec."""
    valid, _ = split_rows(orders, spec or strict_order_spec())
    return valid.select(
        "order_id", "customer_id", "product_id", "quantity",
        F.col("unit_price").try_cast(MONEY).alias("unit_price"), F.col("total").try_cast(MONEY).alias("total"),
        F.timestamp_millis("timestamp").alias("timestamp"), "status",
    )


def store_stats(orders: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Totals over the produced orders, in one row."""
    return orders.agg(
        F.count("*").alias("total"),
        money_sum("total").alias("total_value"),
        last_time(arrival).alias("last_updated"),
    )


def average_order_value(orders: DataFrame) -> DataFrame:
    totals = orders.agg(money_sum("total").alias("v"), F.count("*").alias("n"))
    return totals.select(average("v", "n").alias("average_order_value"))


def store_breakdown(orders: DataFrame) -> DataFrame:
    """Order counts by customer and by product as rows (dimension, key, order_count).

    Kept as rows, since one map over all customers would be a single unbounded value.
    """
    def counted(dimension: str, column: str) -> DataFrame:
        return orders.groupBy(column).agg(F.count("*").alias("order_count")).select(
            F.lit(dimension).alias("dimension"), F.col(column).cast("string").alias("key"), "order_count")

    return counted("customer", "customer_id").unionByName(counted("product", "product_id"))


def top_by_count(orders: DataFrame, key: str, n: int) -> DataFrame:
    counts = orders.groupBy(key).agg(F.count("*").alias("order_count"))
    return top(counts, n, F.desc("order_count"), key)


def raw_customer_totals(raw: DataFrame) -> DataFrame:
    """Per-customer count and exact decimal sum over the raw table."""
    return raw.groupBy("customer_id").agg(
        F.count("*").alias("order_count"), F.sum(F.col("total").cast(MONEY)).alias("total_spent"))


def recent_orders(orders: DataFrame, n: int) -> DataFrame:
    """Newest n orders of an id-unique input, ties by id."""
    return orders.orderBy(F.desc("timestamp"), "order_id").limit(n)


def by_timestamp(orders: DataFrame) -> DataFrame:
    """Orders-by-timestamp view: rows that have both a time and an id."""
    return orders.filter(F.col("timestamp").isNotNull() & F.col("order_id").isNotNull())


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert or replace by primary key; ``incoming`` holds one row per key."""
    kept = current.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def counters(deltas: DataFrame) -> DataFrame:
    """Metric counters: running value per metric; partial sums keep a hot metric cheap."""
    return deltas.groupBy("metric").agg(F.sum("delta").alias("value"))


def typed(df: DataFrame, ints: Sequence[str] = (), doubles: Sequence[str] = (), times: Sequence[str] = (),
          decimals: Sequence[str] = ()) -> DataFrame:
    """Stored row to typed record: null numbers become zero, null texts and times stay null."""
    changed = {c: F.coalesce(F.col(c), F.lit(0)) for c in ints}
    changed |= {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in [*doubles, *decimals]}
    changed |= {c: F.unix_millis(F.col(c).cast("timestamp")) for c in times}
    return df.withColumns(changed)


def outcome_summary(ok: Column, df: DataFrame) -> DataFrame:
    """total / success / errors of a batch."""
    good = F.coalesce(ok, F.lit(False))
    return df.agg(
        F.count("*").alias("total"), F.count_if(good).alias("success"), F.count_if(~good).alias("errors"))
