"""The order feed derived from the given tables: every line item is an order event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.functions.scalars import epoch_millis, round_half_up
from orderlens.schemas import ACCEPTED, DENIED, PENDING

# total arrival orders of the feed, within a customer and within an order id
CUSTOMER_ARRIVAL = ["timestamp", "order_id", "a1", "a2", "total", "quantity"]
ORDER_ARRIVAL = ["timestamp", "a1", "a2", "total", "quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a table out by a key, into the session's shuffle partitions: the exchange that a join by the key needs anyway.

    Without it, a file of one row group would go through all the work up to the join in one task.
    """
    return df.repartition(key)


def order_feed(spark: SparkSession, sf_dir: str, rounded_price: bool = True) -> DataFrame:
    """Order events; ``rounded_price=False`` keeps the exact unit price, so that most rows pass the rules."""
    lines = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    price = F.try_divide("l_extendedprice", "l_quantity")
    return joined.select(
        F.concat_ws("-", F.lit("ORD"), "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (round_half_up(price, 2) if rounded_price else price).alias("unit_price"),
        F.col("l_extendedprice").alias("total"),
        epoch_millis("l_shipdate").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "F", ACCEPTED).when(F.col("o_orderstatus") == "P", PENDING)
        .otherwise(DENIED).alias("status"),
        F.col("l_partkey").alias("a1"), F.col("l_suppkey").alias("a2"),
    )
