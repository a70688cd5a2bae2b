"""Structural specs: per-field predicates over a row, with an account of the failing fields.

A spec is an ordered list of checks. Each yields plain Column expressions, so a spec check is one
projection and stays in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.functions.scalars import valid_natural, valid_positive
from orderlens.schemas import STATUSES

# fixed value: the canonical textual form of an order id
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
# a look-up accepts any five groups of hex digits, at most 36 characters in all
LENIENT_UUID_PATTERN = r"^[0-9a-fA-F]{1,16}(-[0-9a-fA-F]{1,16}){4}\z"


@dataclass(frozen=True)
class Check:
    field: str
    text: str
    holds: Column


@dataclass(frozen=True)
class Spec:
    name: str
    checks: tuple[Check, ...]

    def valid(self) -> Column:
        verdict = self.checks[0].holds
        for check in self.checks[1:]:
            verdict = verdict & check.holds
        return verdict

    def violations(self) -> Column:
        """array<string> of "field: rule" for the failing fields, empty when the row is valid."""
        return F.array_compact(F.array(*[
            F.when(~check.holds, F.lit(f"{check.field}: {check.text}")) for check in self.checks
        ]))

    def explain(self) -> Column:
        """The failing fields as one text, null when the row is valid."""
        return F.when(~self.valid(), F.concat_ws("; ", self.violations()))


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _text(field: str) -> Check:
    return Check(field, "must be text", F.col(field).isNotNull())


def _filled(field: str) -> Check:
    return Check(field, "must be non-empty text", _sure(F.length(field) > 0))


def _positive(field: str) -> Check:
    return Check(field, "must be positive", valid_positive(field))


def _natural(field: str) -> Check:
    return Check(field, "must not be negative", valid_natural(field))


def _nullable_positive(field: str) -> Check:
    return Check(field, "must be positive or null", F.col(field).isNull() | valid_positive(field))


def _status(field: str = "status") -> Check:
    return Check(field, "must be one of " + ", ".join(STATUSES), _sure(F.col(field).isin(*STATUSES)))


def _present(field: str) -> Check:
    return Check(field, "must be present", F.col(field).isNotNull())


def _order_checks(order_id: Check, product_id: Check) -> tuple[Check, ...]:
    return (
        order_id, _positive("customer_id"), product_id, _positive("quantity"),
        _positive("unit_price"), _positive("total"), _positive("timestamp"), _status(),
    )


def order_spec() -> Spec:
    """The gate both processors apply; ids may be empty text here."""
    return Spec("order", _order_checks(_text("order_id"), _text("product_id")))


def strict_order_spec() -> Spec:
    """The producer's gate: the id is a lower-case UUID and the product id is not empty."""
    uuid_check = Check("order_id", "must be a lower-case UUID", _sure(F.col("order_id").rlike(UUID_PATTERN)))
    return Spec("strict_order", _order_checks(uuid_check, _filled("product_id")))


def shared_order_spec() -> Spec:
    return Spec("shared_order", _order_checks(_filled("order_id"), _filled("product_id")))


def customer_stats_spec() -> Spec:
    return Spec("customer_stats", (
        _positive("customer_id"), _natural("total_orders"), _natural("total_spent"),
        _nullable_positive("last_order_timestamp"), _positive("first_order_timestamp"),
    ))


def product_stats_spec() -> Spec:
    return Spec("product_stats", (
        _text("product_id"), _natural("total_quantity"), _natural("total_revenue"),
        _natural("order_count"), _natural("avg_quantity"), _nullable_positive("last_order_timestamp"),
    ))


def timeline_entry_spec() -> Spec:
    return Spec("timeline_entry", _order_checks(_text("order_id"), _text("product_id")))


def processing_stats_spec() -> Spec:
    return Spec("processing_stats", (
        _text("processor_id"), _natural("processed_count"), _natural("error_count"),
        _natural("total_revenue_accepted"), _positive("last_processed_timestamp"),
    ))


def registered_order_spec() -> Spec:
    return Spec("registered_order", (
        _filled("order_id"), _positive("customer_id"), _filled("product_id"), _positive("quantity"),
        _positive("total"), _status(), _positive("registered_at"), _nullable_positive("updated_at"),
        _positive("version"), _present("validation_passed"),
    ))


def order_update_spec() -> Spec:
    return Spec("order_update", (
        _text("order_id"), _positive("version"), _text("new_status"), _positive("updated_at"),
    ))


def validation_stats_spec() -> Spec:
    return Spec("validation_stats", (
        _text("processor_id"), _natural("total_validated"), _natural("total_approved"),
        _natural("total_rejected"), _positive("timestamp"),
    ))


def valid_lookup_id(field: str = "order_id") -> Column:
    """Whether a text is an id the order search accepts."""
    return _sure(F.col(field).rlike(LENIENT_UUID_PATTERN) & (F.length(field) <= 36))


def check_rows(df: DataFrame, spec: Spec) -> DataFrame:
    """The rows with ``valid`` and ``violations``; nothing is dropped."""
    return df.withColumns({"valid": spec.valid(), "violations": spec.violations()})


def split_rows(df: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the spec, the others with their violations)."""
    return df.filter(spec.valid()), df.filter(~spec.valid()).withColumn("violations", spec.violations())


def violation_counts(df: DataFrame, spec: Spec) -> DataFrame:
    """How often each check fails: one conditional count per check in a single pass, then unpivoted."""
    flags = [F.count_if(~check.holds).alias(f"c{i}") for i, check in enumerate(spec.checks)]
    rows = F.array(*[
        F.struct(F.lit(f"{check.field}: {check.text}").alias("violation"), F.col(f"c{i}").alias("row_count"))
        for i, check in enumerate(spec.checks)
    ])
    return df.agg(*flags).select(F.inline(rows)).filter("row_count > 0")
