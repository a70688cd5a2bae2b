"""Versioned registry of approved orders, with history.

The read-modify-write per message becomes neighbour look-ups: a stored order keeps the quantity and
total of its first arrival, and after any later arrival its status is that arrival's status (an unchanged
arrival has the stored status already). So whether an arrival changes the order depends only on the
previous arrival and on the first one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.functions.rules import APPROVED, Rule, outcome
from orderlens.operators.ordering import Arranged, arrange
from orderlens.schemas import ACCEPTED, DENIED

# fixed value: the reason written to the history
UPDATE_REASON = "Status changed"
_CARRIED = ["customer_id", "product_id", "quantity", "unit_price", "total", "timestamp", "status"]


def approved(orders: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    return orders.filter(outcome(rules) == APPROVED)


def verdict_status(passed: Column) -> Column:
    """Status of a newly registered order; the incoming status is not used."""
    return F.when(passed, ACCEPTED).otherwise(DENIED)


def new_registered(orders: DataFrame, passed: Column) -> DataFrame:
    """First registration of validated orders: version 1, status from the verdict."""
    return orders.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "total",
        verdict_status(passed).alias("status"), F.col("timestamp").alias("registered_at"),
        F.lit(None).cast("bigint").alias("updated_at"), F.lit(1).cast("bigint").alias("version"),
        passed.alias("validation_passed"),
    )


def differs(existing: str, incoming: str) -> Column:
    """Whether an incoming order changes the stored one: new, or status, quantity or total differ."""
    old, new = F.col(existing), F.col(incoming)
    same = (
        old["status"].eqNullSafe(new["status"])
        & old["quantity"].eqNullSafe(new["quantity"])
        & old["total"].cast("double").eqNullSafe(new["total"].cast("double"))
    )
    return old.isNull() | ~same


def registry_steps(orders: DataFrame, arrival: Sequence[str], existing: DataFrame | None = None,
                   segments: int | None = None) -> Arranged:
    """Every approved arrival with its effect: rn, changed, previous_status and the version after it.

    ``existing`` holds stored rows (same columns as the result of :func:`registered_orders`); only those
    whose id arrives matter. They enter as the first row of their key.
    """
    order = ["stored_first", *arrival]
    rows = orders.select(
        "order_id", *_CARRIED, *[c for c in arrival if c not in ("order_id", *_CARRIED)],
        F.lit(1).alias("stored_first"), F.lit(None).cast("bigint").alias("stored_version"),
        F.lit(None).cast("bigint").alias("stored_updated_at"),
    )
    if existing is not None:
        stored = existing.select(
            "order_id", "customer_id", "product_id", "quantity", "unit_price", "total",
            F.col("registered_at").alias("timestamp"), "status",
            F.lit(0).alias("stored_first"), F.col("version").alias("stored_version"),
            F.col("updated_at").alias("stored_updated_at"),
        )
        rows = rows.unionByName(stored, allowMissingColumns=True)
    placed = arrange(rows, "order_id", order, segments)
    placed = placed.with_neighbours(["status"], ["quantity", "total", "stored_version"])
    from_store = F.col("head.stored_version").isNotNull()
    stored_status = F.when((F.col("rn") == 2) & ~from_store, F.lit(ACCEPTED)).otherwise(F.col("prev.status"))
    changed = (F.col("rn") > 1) & ~(
        stored_status.eqNullSafe(F.col("status"))
        & F.col("head.quantity").eqNullSafe(F.col("quantity"))
        & F.col("head.total").cast("double").eqNullSafe(F.col("total").cast("double"))
    )
    placed = placed.with_rows(placed.rows.withColumns({
        "changed": changed,
        "previous_status": F.when(F.col("rn") > 1, stored_status),
    }))
    placed = placed.with_running_sum("version", F.col("changed").cast("bigint"))
    return placed.with_rows(placed.rows.withColumn(
        "version", F.col("version") + F.coalesce("head.stored_version", F.lit(1)).cast("bigint")))


def registered_orders(steps: Arranged) -> DataFrame:
    """One row per order id: first arrival's quantity, price and total; last status and version."""
    last = F.max_by(F.struct("status", "rn"), steps.order_struct)
    grouped = steps.rows.groupBy("order_id").agg(
        F.min_by(F.struct(*_CARRIED, "stored_version", "stored_updated_at"), steps.order_struct).alias("head"),
        last.alias("last"),
        F.max("version").alias("version"),
        F.max_by("timestamp", F.when(F.col("changed"), steps.order_struct)).alias("changed_at"),
    )
    only_new = (F.col("last.rn") == 1) & F.col("head.stored_version").isNull()
    return grouped.select(
        "order_id", "head.customer_id", "head.product_id", "head.quantity", "head.unit_price", "head.total",
        F.when(only_new, F.lit(ACCEPTED)).otherwise(F.col("last.status")).alias("status"),
        F.col("head.timestamp").alias("registered_at"),
        F.coalesce("changed_at", "head.stored_updated_at").alias("updated_at"),
        "version", F.lit(True).alias("validation_passed"),
    )


def order_updates(steps: Arranged) -> DataFrame:
    """History: one row per applied change."""
    return steps.rows.filter("changed").select(
        "order_id", "version", "previous_status", F.col("status").alias("new_status"),
        F.col("timestamp").alias("updated_at"), F.lit(UPDATE_REASON).alias("update_reason"),
    )


def step_summary(steps: Arranged) -> DataFrame:
    """How many arrivals registered, updated or were skipped as unchanged."""
    arrived = F.col("stored_first") == 1
    return steps.rows.agg(
        F.count_if(arrived & (F.col("rn") == 1)).alias("registered"),
        F.count_if(arrived & F.col("changed")).alias("updated"),
        F.count_if(arrived & (F.col("rn") > 1) & ~F.col("changed")).alias("skipped"),
    )


def validation_stats(orders: DataFrame, processor_id: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row of counters. A malformed order is rejected without having been validated."""
    bad = F.col("decode_error") if "decode_error" in orders.columns else F.lit(False)
    tagged = orders.select(F.when(~bad, outcome(rules)).alias("outcome"), "timestamp")
    return tagged.agg(
        F.count_if(F.col("outcome").isin("approved", "rejected")).alias("total_validated"),
        F.count_if(F.col("outcome") == "approved").alias("total_approved"),
        F.count_if(F.col("outcome").isin("rejected", "malformed")).alias("total_rejected"),
        F.count_if(F.col("outcome").isNull()).alias("undecodable"),
        F.max(F.when(F.col("outcome") != "malformed", F.col("timestamp"))).alias("timestamp"),
    ).select(F.lit(processor_id).alias("processor_id"), "*")


def override_counters(overrides: DataFrame, processor_id: str = "monitor-api") -> DataFrame:
    """Counters of manual decisions, one validated row per override."""
    return overrides.agg(
        F.count("*").alias("total_validated"),
        F.count_if(F.col("new_status") == ACCEPTED).alias("total_approved"),
        F.count_if(F.col("new_status") == DENIED).alias("total_rejected"),
    ).select(F.lit(processor_id).alias("processor_id"), "*")
