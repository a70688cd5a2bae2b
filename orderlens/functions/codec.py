"""JSON boundary: kebab-case messages to typed rows and back.

Numbers are read as DOUBLE and narrowed afterwards. That accepts 5, 5.7 and 3e10 as numbers, refuses
quoted numbers, and makes bad JSON a row with ``decode_error`` instead of a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderlens.functions.rules import RULE_RESULTS, VALIDATION_RESULT
from orderlens.schemas import ORDER_COLUMNS

_CORRUPT = "_corrupt"
_INT_LIMIT = 2_147_483_647
_LONG_LIMIT = 9_223_372_036_854_775_807
_KINDS = {"order_id": "STRING", "product_id": "STRING", "status": "STRING"}


def _renamed(kind: T.DataType, rename) -> T.DataType:
    """The same type with other field names; casting to it renames nested fields without touching values."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(rename(f.name), _renamed(f.dataType, rename)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType, rename), kind.containsNull)
    return kind


def _kebab(name: str) -> str:
    return name.replace("_", "-")


_ORDER_FIELDS = ", ".join(f"`{_kebab(c)}` {_KINDS.get(c, 'DOUBLE')}" for c in ORDER_COLUMNS)
_ENVELOPE_FIELDS = (
    f"`order` STRUCT<{_ORDER_FIELDS.replace('` ', '`: ')}>, "
    "`validation-result` STRUCT<`order-id`: STRING, `passed`: BOOLEAN, "
    "`rules`: ARRAY<STRUCT<`rule-name`: STRING, `passed`: BOOLEAN, `message`: STRING>>, `message`: STRING>, "
    "`timestamp` DOUBLE"
)


def _parse(value: Column, fields: str) -> Column:
    return F.from_json(value, f"{fields}, `{_CORRUPT}` STRING",
                       {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})


def _whole(value: Column, limit: int, kind: str) -> Column:
    """Drop the fraction; null when missing, not a number or out of range."""
    cut = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)) if kind == "int" else value
    in_range = F.abs(value) <= float(limit)
    return F.when(in_range & ~F.isnan(value), cut.cast(kind))


def _order_fields(parsed: Column) -> dict[str, Column]:
    field = {c: parsed[_kebab(c)] for c in ORDER_COLUMNS}
    return {
        "order_id": field["order_id"],
        "customer_id": _whole(field["customer_id"], _INT_LIMIT, "int"),
        "product_id": field["product_id"],
        "quantity": _whole(field["quantity"], _INT_LIMIT, "int"),
        "unit_price": field["unit_price"],
        "total": field["total"],
        "timestamp": _whole(field["timestamp"], _LONG_LIMIT, "bigint"),
        "status": field["status"],
    }


def decode_orders(messages: DataFrame, strict_money: bool = True, value: str = "value") -> DataFrame:
    """Messages to orders plus ``decode_error``; the other columns of the message are kept.

    ``strict_money=True`` is the aggregation reader (price and total must be numbers); with False a missing
    price or total decodes to null and is left to the gate.
    """
    kept = [c for c in messages.columns if c not in (value, "timestamp", "key")]
    arrival = [F.col("timestamp").alias("arrival_time")] if "timestamp" in messages.columns else []
    parsed = messages.select(*kept, *arrival, _parse(F.col(value), _ORDER_FIELDS).alias("m"))
    fields = _order_fields(F.col("m"))
    needed = ["customer_id", "quantity", "timestamp"] + (["unit_price", "total"] if strict_money else [])
    # an object is required: null, a list or a bare value has none of the fields
    missing = F.col("m").isNull()
    for name in needed:
        missing = missing | fields[name].isNull()
    error = F.col(f"m.{_CORRUPT}").isNotNull() | missing
    return parsed.select(
        *kept, *[c for c in ["arrival_time"] if arrival], *[v.alias(k) for k, v in fields.items()],
        F.coalesce(error, F.lit(True)).alias("decode_error"),
    )


def decode_strict(messages: DataFrame, value: str = "value") -> DataFrame:
    """The producer's reader: counts must be whole numbers in the text, so 5.7 or 5.0 is an error too."""
    whole = {"customer_id": "INT", "quantity": "INT", "timestamp": "BIGINT"}
    fields = ", ".join(f"`{_kebab(c)}` {whole.get(c) or _KINDS.get(c, 'DOUBLE')}" for c in ORDER_COLUMNS)
    kept = [c for c in messages.columns if c not in (value, "timestamp", "key")]
    parsed = messages.select(*kept, _parse(F.col(value), fields).alias("m"))
    return parsed.select(
        *kept, *[F.col("m")[_kebab(c)].alias(c) for c in ORDER_COLUMNS],
        (F.col("m").isNull() | F.col(f"m.{_CORRUPT}").isNotNull()).alias("decode_error"),
    )


def decode_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Registry messages to orders; ``usable`` is false where the row is to be skipped."""
    kept = [c for c in messages.columns if c not in (value, "timestamp", "key")]
    arrival = [F.col("timestamp").alias("arrival_time")] if "timestamp" in messages.columns else []
    parsed = messages.select(*kept, *arrival, _parse(F.col(value), _ENVELOPE_FIELDS).alias("e"))
    corrupt = F.coalesce(F.col(f"e.{_CORRUPT}").isNotNull() | F.col("e").isNull(), F.lit(True))
    verdict = F.col("e.validation-result")
    return parsed.select(
        *kept, *[c for c in ["arrival_time"] if arrival],
        *[v.alias(k) for k, v in _order_fields(F.col("e.order")).items()],
        verdict["passed"].alias("passed"),
        verdict["rules"].cast(RULE_RESULTS).alias("rules"),
        corrupt.alias("decode_error"),
        (~corrupt & F.col("e.order").isNotNull() & F.coalesce(verdict["passed"], F.lit(False))).alias("usable"),
    )


def to_json(columns: Sequence[str], kebab: bool = True, keep_nulls: bool = True) -> Column:
    named = [F.col(c).alias(_kebab(c) if kebab else c) for c in columns]
    return F.to_json(F.struct(*named), {"ignoreNullFields": "false" if keep_nulls else "true"})


def encode_orders(orders: DataFrame) -> DataFrame:
    """Orders to (key, value) messages."""
    return orders.select(F.col("order_id").alias("key"), to_json(ORDER_COLUMNS).alias("value"))


def result_json(result: str = "validation_result") -> Column:
    """A validation result as a kebab-case JSON object."""
    return F.to_json(kebab_result(result), {"ignoreNullFields": "false"})


def kebab_result(result: str) -> Column:
    return F.col(result).cast(_renamed(VALIDATION_RESULT, _kebab))


def envelope_json(at: Column) -> Column:
    """The registry message of a validated order."""
    order = F.struct(*[F.col(c).alias(_kebab(c)) for c in ORDER_COLUMNS])
    body = F.struct(
        order.alias("order"), kebab_result("validation_result").alias("validation-result"),
        at.alias("timestamp"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def encode_envelopes(validated: DataFrame, at: Column) -> DataFrame:
    """Approved, validated orders to registry messages keyed by order id."""
    return validated.select(F.col("order_id").alias("key"), envelope_json(at).alias("value"))
