"""Business rules as data: a name, a condition and a message, all Column expressions.

A rule list is a plain Python list, so users add rules of their own without any Python UDF. Verdict,
message and failed names are built from the conditions directly, never by walking the result array, so
they stay in generated code and only the columns a query reads are computed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderlens.functions.specs import order_spec
from orderlens.schemas import STATUSES


@dataclass(frozen=True)
class RuleConfig:
    # fixed values: limits of the default rules
    min_quantity: int = 1
    max_quantity: int = 1000
    min_total: float = 1.0
    max_total: float = 100000.0
    price_tolerance: float = 0.01
    valid_statuses: tuple[str, ...] = STATUSES


# fixed value: the producer accepts a difference strictly below this
PRODUCER_TOLERANCE = 0.02
PRODUCER_MESSAGE = "Total must equal quantity * unit-price"


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    message: Column

    @property
    def passed(self) -> Column:
        """A comparison with a missing value counts as failed."""
        return F.coalesce(self.holds, F.lit(False))

    def result(self) -> Column:
        return F.struct(
            F.lit(self.name).alias("rule_name"), self.passed.alias("passed"),
            F.when(~self.passed, self.message).alias("message"),
        )


RULE_RESULTS = T.ArrayType(
    T.StructType().add("rule_name", T.StringType()).add("passed", T.BooleanType()).add("message", T.StringType()))
VALIDATION_RESULT = (
    T.StructType().add("order_id", T.StringType()).add("passed", T.BooleanType())
    .add("rules", RULE_RESULTS).add("message", T.StringType())
)


def _said(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), F.coalesce(value.cast("string"), F.lit("")))


def default_rules(config: RuleConfig = RuleConfig()) -> list[Rule]:
    """The eight rules in reporting order. Names and messages are fixed values."""
    quantity, total = F.col("quantity"), F.col("total").cast("double")
    expected = quantity * F.col("unit_price").cast("double")
    return [
        Rule("minimum-quantity", quantity >= config.min_quantity,
             _said(f"Quantity must be at least {config.min_quantity}, got: ", quantity)),
        Rule("maximum-quantity", quantity <= config.max_quantity,
             _said(f"Quantity exceeds maximum of {config.max_quantity}, got: ", quantity)),
        # NaN sorts above every number, and must not pass
        Rule("minimum-total", (total >= config.min_total) & ~F.isnan(total),
             _said(f"Total must be at least ${config.min_total}, got: $", total)),
        Rule("maximum-total", total <= config.max_total,
             _said(f"Total exceeds maximum of ${config.max_total}, got: $", total)),
        Rule("price-consistency", F.abs(total - expected) <= config.price_tolerance,
             F.concat(_said("Total mismatch. Expected: $", expected), _said(", got: $", total))),
        Rule("valid-status", F.col("status").isin(*config.valid_statuses),
             _said("Invalid status: ", F.col("status"))),
        Rule("valid-customer-id", F.col("customer_id") > 0,
             _said("Invalid customer ID: ", F.col("customer_id"))),
        Rule("valid-product-id", F.length("product_id") > 0,
             F.lit("Product ID cannot be empty")),
    ]


def _or_default(rules: Sequence[Rule] | None) -> list[Rule]:
    return list(default_rules() if rules is None else rules)


def all_passed(rules: Sequence[Rule] | None = None) -> Column:
    verdict = F.lit(True)
    for each in _or_default(rules):
        verdict = verdict & each.passed
    return verdict


def failure_message(rules: Sequence[Rule] | None = None) -> Column:
    """"Validation failed: m1, m2" over the failed rules in list order, null when all pass."""
    chosen = _or_default(rules)
    said = F.concat_ws(", ", *[F.when(~r.passed, r.message) for r in chosen])
    return F.when(~all_passed(chosen), F.concat(F.lit("Validation failed: "), said))


def failed_rules(rules: Sequence[Rule] | None = None) -> Column:
    """Names of the failed rules, in list order."""
    return F.array_compact(F.array(*[F.when(~r.passed, F.lit(r.name)) for r in _or_default(rules)]))


def failure_summary(rules: Sequence[Rule] | None = None) -> Column:
    chosen = _or_default(rules)
    names = F.concat_ws(", ", *[F.when(~r.passed, F.lit(r.name)) for r in chosen])
    return F.when(~all_passed(chosen), F.concat(F.lit("Failed rules: "), names))


def stored_failed_rules(result: str = "validation_result") -> Column:
    """Names of the failed rules of a validation result that was read back."""
    return F.transform(F.filter(F.col(f"{result}.rules"), lambda r: ~r["passed"]), lambda r: r["rule_name"])


def validation_result(rules: Sequence[Rule] | None = None) -> Column:
    """struct<order_id, passed, rules, message> over all rules, kept in list order."""
    chosen = _or_default(rules)
    return F.struct(
        F.col("order_id"), all_passed(chosen).alias("passed"),
        F.array(*[r.result() for r in chosen]).alias("rules"), failure_message(chosen).alias("message"),
    )


def validate_orders(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    return df.withColumn("validation_result", validation_result(rules))


MALFORMED, REJECTED, APPROVED = "malformed", "rejected", "approved"


def outcome(rules: Sequence[Rule] | None = None) -> Column:
    """Gate, then rules: malformed / rejected / approved."""
    return (
        F.when(~order_spec().valid(), MALFORMED)
        .when(all_passed(rules), APPROVED)
        .otherwise(REJECTED)
    )


def failures_per_rule(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Failures per rule among the well-formed rows.

    One conditional count per rule in a single pass; no row is exploded, so no rule can become a hot key.
    """
    chosen = _or_default(rules)
    tallied = df.filter(order_spec().valid()).agg(
        *[F.count_if(~r.passed).alias(f"n{at}") for at, r in enumerate(chosen)])
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.col(f"n{at}").alias("failures"))
        for at, r in enumerate(chosen)
    ])
    return tallied.select(F.inline(rows)).filter("failures > 0")


def producer_check(df: DataFrame) -> DataFrame:
    """The producer's own check: |quantity * price - total| below two cents."""
    gap = F.abs(F.col("quantity") * F.col("unit_price") - F.col("total"))
    matches = F.coalesce(gap < PRODUCER_TOLERANCE, F.lit(False))
    no_errors = F.array().cast("array<string>")
    return df.withColumns({
        "business_valid": matches,
        "business_errors": F.when(matches, no_errors).otherwise(F.array(F.lit(PRODUCER_MESSAGE))),
    })
