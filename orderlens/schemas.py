"""Fixed schemas of the order event, the topic log and the nine stored tables.

Counters are BIGINT throughout, since a 32-bit counter overflows at scale. Event times are
epoch milliseconds in events and TIMESTAMP in stored tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# fixed values: the order statuses
PENDING, ACCEPTED, DENIED = "pending", "accepted", "denied"
STATUSES = (PENDING, ACCEPTED, DENIED)

ORDER_COLUMNS = [
    "order_id", "customer_id", "product_id", "quantity",
    "unit_price", "total", "timestamp", "status",
]

MONEY = T.DecimalType(18, 2)


ORDER = (
    T.StructType()
    .add("order_id", T.StringType())
    .add("customer_id", T.IntegerType())
    .add("product_id", T.StringType())
    .add("quantity", T.IntegerType())
    .add("unit_price", T.DoubleType())
    .add("total", T.DoubleType())
    .add("timestamp", T.LongType())
    .add("status", T.StringType())
)

TOPIC_RECORD = (
    T.StructType()
    .add("key", T.StringType())
    .add("value", T.StringType())
    .add("topic", T.StringType())
    .add("partition", T.IntegerType())
    .add("offset", T.LongType())
    .add("timestamp", T.TimestampType())
)


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its columns and the columns that identify a row.

    ``grows`` marks tables that get new keys for ever and hardly replace any; they are never rewritten whole.
    ``bucket_by`` names the column whose hash picks a row's bucket folder; tables of few rows have none.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    grows: bool = False
    bucket_by: str | None = None


def _table(name: str, keys: str, columns: str, grows: bool = False, bucket_by: str | None = None) -> TableSpec:
    # the "name TYPE" text is turned into a StructType without needing a live session
    kinds = {
        "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
        "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(),
        "BOOLEAN": T.BooleanType(), "MONEY": MONEY,
    }
    schema = T.StructType()
    for column in columns.split(","):
        label, kind = column.split()
        schema = schema.add(label, kinds[kind])
    return TableSpec(name, schema, tuple(keys.split()), grows, bucket_by)


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        _table("orders", "order_id",
               "order_id STRING, customer_id INT, product_id STRING, quantity INT, unit_price MONEY, "
               "total MONEY, timestamp TIMESTAMP, status STRING", grows=True, bucket_by="order_id"),
        _table("statistics", "metric", "metric STRING, value BIGINT"),
        _table("orders_by_customer", "customer_id",
               "customer_id INT, total_orders BIGINT, total_spent DOUBLE, last_order_id STRING, "
               "last_order_timestamp TIMESTAMP, first_order_timestamp TIMESTAMP", bucket_by="customer_id"),
        _table("orders_by_product", "product_id",
               "product_id STRING, total_quantity BIGINT, total_revenue DOUBLE, order_count BIGINT, "
               "avg_quantity DOUBLE, last_order_timestamp TIMESTAMP", bucket_by="product_id"),
        _table("orders_timeline", "timestamp order_id",
               "timestamp TIMESTAMP, order_id STRING, customer_id INT, product_id STRING, quantity INT, "
               "unit_price DOUBLE, total DOUBLE, status STRING", grows=True, bucket_by="order_id"),
        _table("processing_stats", "processor_id",
               "processor_id STRING, processed_count BIGINT, error_count BIGINT, "
               "total_revenue_accepted DOUBLE, last_processed_timestamp TIMESTAMP"),
        _table("registered_orders", "order_id",
               "order_id STRING, customer_id INT, product_id STRING, quantity INT, unit_price DOUBLE, "
               "total DOUBLE, status STRING, registered_at TIMESTAMP, updated_at TIMESTAMP, version BIGINT, "
               "validation_passed BOOLEAN", bucket_by="order_id"),
        _table("order_updates", "order_id version",
               "order_id STRING, version BIGINT, previous_status STRING, new_status STRING, "
               "updated_at TIMESTAMP, update_reason STRING", grows=True, bucket_by="order_id"),
        _table("validation_stats", "processor_id",
               "processor_id STRING, total_validated BIGINT, total_approved BIGINT, total_rejected BIGINT, "
               "timestamp TIMESTAMP"),
    ]
}
