"""Shared inputs of the queries: the feed and the views derived from it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.functions.codec import to_json
from orderlens.operators import registry, views
from orderlens.operators.ordering import Arranged
from orderlens.schemas import ORDER_COLUMNS
from orderlens.session import fresh_dir, stored
from orderlens.sources import topics
from orderlens.sources.feed import CUSTOMER_ARRIVAL, ORDER_ARRIVAL, order_feed

TIMELINE_ARRIVAL = ["timestamp", "order_id", "a1", "a2", "total", "quantity"]


def feed(spark: SparkSession, d: str) -> DataFrame:
    return order_feed(spark, d)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return order_feed(spark, d, rounded_price=False)


def gated(spark: SparkSession, d: str) -> DataFrame:
    return views.gated(feed(spark, d))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_stats(gated(spark, d), CUSTOMER_ARRIVAL)


def customer_totals(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_totals(gated(spark, d), CUSTOMER_ARRIVAL)


def products(spark: SparkSession, d: str) -> DataFrame:
    return views.product_stats(gated(spark, d), ORDER_ARRIVAL)


def entries(spark: SparkSession, d: str) -> DataFrame:
    """The stored timeline."""
    rows = views.timeline_entries(gated(spark, d), "a1", "a2")
    return views.stored_timeline(rows, TIMELINE_ARRIVAL).select(*ORDER_COLUMNS)


def steps(spark: SparkSession, d: str, exact_price: bool = False) -> Arranged:
    orders = clean(spark, d) if exact_price else feed(spark, d)
    return registry.registry_steps(registry.approved(orders), ORDER_ARRIVAL)


def registered(spark: SparkSession, d: str, exact_price: bool = True) -> DataFrame:
    return registry.registered_orders(steps(spark, d, exact_price))


def updates(spark: SparkSession, d: str, exact_price: bool = True) -> DataFrame:
    return registry.order_updates(steps(spark, d, exact_price))


def uuid_feed(spark: SparkSession, d: str) -> DataFrame:
    """The feed with UUID-shaped ids, as the producer makes them."""
    digest = F.md5("order_id")
    pieces = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return clean(spark, d).withColumn("order_id", F.concat_ws("-", *pieces))


def messages(orders: DataFrame) -> DataFrame:
    """Orders as topic records: partition by order id, dense offsets in arrival order."""
    return encoded(topics.assign_offsets(orders.select(*ORDER_COLUMNS, "a1", "a2"), TIMELINE_ARRIVAL, key="order_id"))


def encoded(placed: DataFrame) -> DataFrame:
    """Orders with their places as topic records; the text is made last, as it is three times as long as the columns."""
    return placed.select(
        F.col("order_id").alias("key"), to_json(ORDER_COLUMNS).alias("value"),
        F.timestamp_millis("timestamp").alias("timestamp"), "partition", "offset")


class Deliveries(topics.Placement):
    """The records of :func:`messages` in passes, to be written in one or several deliveries."""

    def parts(self, since: int | None = None, before: int | None = None) -> list[DataFrame]:
        return [encoded(part) for part in super().parts(since, before)]


@contextmanager
def deliveries(spark: SparkSession, orders: DataFrame, label: str, cuts: Sequence[int] = ()) -> Iterator[Deliveries]:
    """``cuts`` are the times at which a delivery may begin or end. The orders are computed once and stored meanwhile."""
    with stored(orders.select(*ORDER_COLUMNS, "a1", "a2"), fresh_dir(spark, f"{label}-feed")) as rows:
        yield Deliveries(rows, TIMELINE_ARRIVAL, "order_id", cuts)


def written_log(spark: SparkSession, orders: DataFrame, label: str) -> str:
    """A topic log of the orders in the shared folder; returns its root."""
    root = fresh_dir(spark, label)
    with deliveries(spark, orders, label) as placed:
        topics.write_log(placed.parts(), root, topics.ORDERS)
    return root
