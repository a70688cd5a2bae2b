"""Literal rule boundaries, spec verdicts, validation outcomes."""

import pytest
from pyspark.sql import functions as F

from orderlens.functions import rules, specs
from orderlens.operators import registry

BASE = ("ORDER-VALID-001", 42, "PROD-VALID-001", 5, 30.0, 150.0, 1234567890, "accepted")
FIELDS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "total", "timestamp", "status"]


def changed(**values):
    return tuple(values.get(f, v) for f, v in zip(FIELDS, BASE))


@pytest.mark.parametrize("field, passing, failing, rule", [
    ("quantity", [1], [0], "minimum-quantity"),
    ("quantity", [1000], [1001], "maximum-quantity"),
    ("total", [1.0], [0.99, float("nan")], "minimum-total"),
    ("total", [100000.0], [100000.01], "maximum-total"),
    ("total", [150.0, 150.01, 149.99], [999.0, 150.02], "price-consistency"),
    ("status", ["pending", "accepted", "denied"], ["invalid_status", None], "valid-status"),
    ("customer_id", [1], [0, -1], "valid-customer-id"),
    ("product_id", ["PROD-123"], ["", None], "valid-product-id"),
])
def test_rule_boundaries(orders, field, passing, failing, rule):
    rows = [changed(**{field: v}) for v in [*passing, *failing]]
    got = rules.validate_orders(orders(*rows)).orderBy("seq").select("validation_result.rules").collect()
    verdicts = [{r["rule_name"]: r["passed"] for r in row["rules"]}[rule] for row in got]
    assert verdicts == [True] * len(passing) + [False] * len(failing)


def test_eight_rules_in_order_and_messages(orders):
    df = rules.validate_orders(orders(
        BASE, changed(quantity=1000, unit_price=100.0, total=100000.0), changed(quantity=1, unit_price=1.0, total=1.0),
        changed(quantity=2000, total=-10.0, status="bad")))
    ok, big, small, bad = [r["validation_result"] for r in df.orderBy("seq").collect()]
    assert [r["rule_name"] for r in ok["rules"]] == [
        "minimum-quantity", "maximum-quantity", "minimum-total", "maximum-total",
        "price-consistency", "valid-status", "valid-customer-id", "valid-product-id"]
    assert ok["passed"] and big["passed"] and small["passed"] and ok["message"] is None
    assert bad["message"] == (
        "Validation failed: Quantity exceeds maximum of 1000, got: 2000, Total must be at least $1.0, got: $-10.0, "
        "Total mismatch. Expected: $60000.0, got: $-10.0, Invalid status: bad")
    summary = df.filter("seq = 3").select(rules.failed_rules(), rules.failure_summary()).first()
    assert df.filter("seq = 3").select(rules.stored_failed_rules()).first()[0] == summary[0]
    assert summary[0] == ["maximum-quantity", "minimum-total", "price-consistency", "valid-status"]
    assert summary[1] == "Failed rules: maximum-quantity, minimum-total, price-consistency, valid-status"


def test_producer_check(orders):
    df = rules.producer_check(orders(changed(unit_price=10.99, total=54.95), changed(unit_price=10.99, total=999.99)))
    good, bad = df.orderBy("seq").collect()
    assert good["business_valid"] and good["business_errors"] == []
    assert not bad["business_valid"] and bad["business_errors"] == ["Total must equal quantity * unit-price"]


def test_validation_counters(orders):
    df = orders(BASE, changed(quantity=2000, total=60000.0), changed(customer_id=0))
    row = registry.validation_stats(df, "p").first()
    assert (row["total_validated"], row["total_approved"], row["total_rejected"]) == (2, 1, 2)
    outcomes = [r[0] for r in df.orderBy("seq").select(rules.outcome()).collect()]
    assert outcomes == ["approved", "rejected", "malformed"]


def test_user_rules_extend_the_list(orders):
    even = rules.Rule("even-quantity", F.col("quantity") % 2 == 0, F.lit("odd"))
    row = rules.validate_orders(orders(BASE), [*rules.default_rules(), even]).first()["validation_result"]
    assert not row["passed"] and row["message"] == "Validation failed: odd" and len(row["rules"]) == 9
    counts = {r[0]: r[1] for r in rules.failures_per_rule(orders(BASE, BASE), [even]).collect()}
    assert counts == {"even-quantity": 2}


UUID = "123e4567-e89b-12d3-a456-426614174000"


@pytest.mark.parametrize("spec, good, bad", [
    (specs.order_spec, [BASE, changed(order_id=""), changed(product_id="")],
     [changed(order_id=None), changed(customer_id=0), changed(quantity=-1), changed(unit_price=0.0),
      changed(total=float("nan")), changed(timestamp=0), changed(status="shipped"), changed(status=None)]),
    (specs.shared_order_spec, [BASE], [changed(order_id=""), changed(product_id="")]),
    (specs.strict_order_spec, [changed(order_id=UUID)],
     [BASE, changed(order_id=UUID.upper()), changed(order_id=UUID + "\n"), changed(order_id=UUID, product_id="")]),
])
def test_order_specs(orders, spec, good, bad):
    flagged = specs.check_rows(orders(*good, *bad), spec()).orderBy("seq").collect()
    assert [r["valid"] for r in flagged] == [True] * len(good) + [False] * len(bad)
    assert all((r["violations"] == []) == r["valid"] for r in flagged)


def test_explain_and_counts(orders):
    df = orders(BASE, changed(customer_id=0, quantity=0), changed(customer_id=None))
    texts = [r[0] for r in df.orderBy("seq").select(specs.order_spec().explain()).collect()]
    assert texts == [None, "customer_id: must be positive; quantity: must be positive", "customer_id: must be positive"]
    counts = dict(tuple(r) for r in specs.violation_counts(df, specs.order_spec()).collect())
    assert counts == {"customer_id: must be positive": 2, "quantity: must be positive": 1}


def test_view_specs(spark):
    stats = spark.createDataFrame(
        [(42, 5, 500.0, "ORDER-123", 1234567890, 1234560000), (42, 5, 500.0, None, None, 1), (42, -1, 1.0, "x", 1, 1),
         (42, 1, 1.0, "x", 1, None)],
        "customer_id int, total_orders long, total_spent double, last_order_id string, last_order_timestamp long, "
        "first_order_timestamp long")
    assert [r[0] for r in stats.select(specs.customer_stats_spec().valid()).collect()] == [True, True, False, False]
    products = spark.createDataFrame(
        [("PROD-A", 50, 1500.0, 10, 5.0, 1234567890), ("PROD-A", 0, 0.0, 0, 0.0, None), ("P", 1, -1.0, 1, 1.0, 1)],
        "product_id string, total_quantity long, total_revenue double, order_count long, avg_quantity double, "
        "last_order_timestamp long")
    assert [r[0] for r in products.select(specs.product_stats_spec().valid()).collect()] == [True, True, False]
    updates = spark.createDataFrame([("O", 2, None, "accepted", 1, None), ("O", 0, "pending", "accepted", 1, "r")],
                                    "order_id string, version long, previous_status string, new_status string, "
                                    "updated_at long, update_reason string")
    assert [r[0] for r in updates.select(specs.order_update_spec().valid()).collect()] == [True, False]


def test_lookup_ids(spark):
    df = spark.createDataFrame([(UUID,), (UUID.upper(),), ("1-2-3-4-5",), ("not-a-uuid",), ("",), (None,)], "order_id string")
    assert [r[0] for r in df.select(specs.valid_lookup_id()).collect()] == [True, True, True, False, False, False]
