"""Folds rewritten as windows and aggregates, against the event-at-a-time model, in one segment and in many."""

import random

import pytest
from pyspark.sql import functions as F

from tests import folds
from orderlens.operators import monitor, registry, store, timeline, views
from orderlens.operators.ordering import SEGMENT, arrange, group_in_chunks
from orderlens.schemas import ORDER_COLUMNS

ARRIVAL = ["seq"]
# so many segments that most keys reach over several
CUT_ALL = 30


def random_rows(seed, n, ids=12, customers=5, hot=0.34):
    """Rows in which one customer and one order id hold about a third of all rows, with exact copies."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        order_id = "HOT" if rnd.random() < hot else f"O{rnd.randrange(ids)}"
        customer = 1 if rnd.random() < hot else rnd.randrange(2, 2 + customers)
        quantity = rnd.choice([1, 1, 1, 2])
        rows.append((order_id, customer, f"P{rnd.randrange(3)}", quantity, 10.0, quantity * 10.0, rnd.randrange(1, 50),
                     rnd.choice(["pending", "accepted", "denied"])))
    return rows


def as_dicts(rows):
    return [dict(zip(ORDER_COLUMNS, r)) for r in rows]


T1 = ("ORDER-001", 100, "PROD-X", 2, 50.0, 100.0, 5000, "accepted")
T2 = ("ORDER-002", 100, "PROD-Y", 1, 75.0, 75.0, 6000, "pending")
T3 = ("ORDER-003", 200, "PROD-X", 5, 50.0, 250.0, 7000, "denied")


def test_literal_views(orders):
    df = orders(T1, T2, T3)
    row = views.customer_stats(df, ARRIVAL).filter("customer_id = 100").first()
    assert tuple(row) == (100, 2, 175.0, "ORDER-002", 6000, 5000)
    row = views.product_stats(df, ARRIVAL).filter("product_id = 'PROD-X'").first()
    assert tuple(row) == ("PROD-X", 7, 350.0, 2, 3.5, 7000)
    stats = views.processing_stats(df, "p").first()
    assert (stats["processed_count"], stats["error_count"], stats["total_revenue_accepted"]) == (3, 0, 100.0)


def test_duplicate_guard(orders):
    twice = orders(T1, T1)
    assert views.customer_stats(twice, ARRIVAL).first()["total_orders"] == 1
    assert views.processing_stats(twice, "p").first()["processed_count"] == 2
    assert views.product_stats(twice, ARRIVAL).first()["order_count"] == 2
    a_b_a = orders(T1, T2, T1)
    assert tuple(views.customer_stats(a_b_a, ARRIVAL).first()) == (100, 3, 275.0, "ORDER-001", 5000, 5000)


def test_late_event_overwrites_last(orders):
    row = views.customer_stats(orders(T2, T1), ARRIVAL).first()
    assert (row["last_order_id"], row["last_order_timestamp"], row["first_order_timestamp"]) == ("ORDER-001", 5000, 6000)


@pytest.mark.parametrize("segments", [1, None, CUT_ALL])
@pytest.mark.parametrize("seed", [1, 2])
def test_customer_fold(orders, segments, seed):
    rows = random_rows(seed, 150)
    got = views.customer_stats(orders(*rows), ARRIVAL, segments).collect()
    assert {r["customer_id"]: (r["total_orders"], round(r["total_spent"] * 100), r["last_order_id"],
                               r["last_order_timestamp"], r["first_order_timestamp"]) for r in got} == folds.customers(
        as_dicts(rows))


@pytest.mark.parametrize("segments", [1, None, CUT_ALL])
@pytest.mark.parametrize("seed", [3, 4])
def test_registry_fold(orders, segments, seed):
    rows = random_rows(seed, 150)
    steps = registry.registry_steps(orders(*rows), ARRIVAL, segments=segments)
    want, history = folds.registry(as_dicts(rows))
    got = {r["order_id"]: (r["status"], r["version"], r["quantity"], r["total"])
           for r in registry.registered_orders(steps).collect()}
    assert got == want
    updates = registry.order_updates(steps).collect()
    assert sorted((r["order_id"], r["version"], r["previous_status"], r["new_status"]) for r in updates) == history
    summary = registry.step_summary(steps).first()
    assert (summary["registered"], summary["updated"]) == (len(want), len(history))
    assert sum(summary) == len(rows)


@pytest.mark.parametrize("segments", [1, None, CUT_ALL])
def test_registry_continues_from_stored_rows(orders, segments):
    rows = random_rows(5, 120)
    df = orders(*rows)
    first = registry.registry_steps(df.filter("seq < 50"), ARRIVAL, segments=segments)
    stored = registry.registered_orders(first)
    second = registry.registry_steps(df.filter("seq >= 50"), ARRIVAL, stored, segments)
    merged = store.upsert(stored, registry.registered_orders(second), ["order_id"])
    want, history = folds.registry(as_dicts(rows))
    assert {r["order_id"]: (r["status"], r["version"], r["quantity"], r["total"]) for r in merged.collect()} == want
    both = registry.order_updates(first).unionByName(registry.order_updates(second)).collect()
    assert sorted((r["order_id"], r["version"], r["previous_status"], r["new_status"]) for r in both) == history


@pytest.mark.parametrize("segments", [1, None, CUT_ALL])
def test_customers_continue_from_stored_rows(orders, segments):
    rows = random_rows(6, 120)
    df = orders(*rows)
    stored = views.customer_stats(df.filter("seq < 60"), ARRIVAL)
    fresh = views.fold_customers(df.filter("seq >= 60"), ARRIVAL, stored, segments)
    merged = store.upsert(stored, fresh, ["customer_id"]).collect()
    assert {r["customer_id"]: (r["total_orders"], round(r["total_spent"] * 100), r["last_order_id"],
                               r["last_order_timestamp"], r["first_order_timestamp"]) for r in merged} == folds.customers(
        as_dicts(rows))


def test_exact_copies_are_spread(orders):
    """All arrival columns equal: the copies still go to several segments, and the result stays right."""
    df = orders(*[T1] * 40, T2).drop("seq")
    cut = arrange(df, "customer_id", ["timestamp"], CUT_ALL)
    sizes = [r["count"] for r in cut.rows.groupBy(SEGMENT).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20
    assert views.customer_stats(df, ["timestamp"], CUT_ALL).first()["total_orders"] == 2


@pytest.mark.parametrize("segments", [1, None, CUT_ALL])
def test_group_in_chunks(orders, segments):
    df = orders(*random_rows(8, 100)).select("customer_id", "order_id", "seq")
    got = group_in_chunks(df, "customer_id", ["seq"], 7, segments).orderBy("customer_id", "chunk").collect()
    assert all(r["row_count"] == len(r["items"]) <= 7 for r in got)
    joined = {}
    for r in got:
        assert r["chunk"] == len([g for g in got if g["customer_id"] == r["customer_id"] and g["chunk"] < r["chunk"]])
        joined.setdefault(r["customer_id"], []).extend(item["seq"] for item in r["items"])
    want = {}
    for r in df.orderBy("seq").collect():
        want.setdefault(r["customer_id"], []).append(r["seq"])
    assert joined == want


# --- timeline ------------------------------------------------------------------------------------------


def ring_ids(df, **options):
    return [r["order_id"] for r in timeline.timeline_ring(df, ARRIVAL, **options).orderBy("ring_position").collect()]


def test_literal_ring(orders):
    assert ring_ids(orders(T1, T2, T3)) == ["ORDER-003", "ORDER-002", "ORDER-001"]
    assert ring_ids(orders(T1, T2, T3), size=2) == ["ORDER-003", "ORDER-002"]
    assert ring_ids(orders(T1, T1)) == ["ORDER-001"]
    assert ring_ids(orders(T1, T2, T1)) == ["ORDER-002", "ORDER-001"]


@pytest.mark.parametrize("seed, size, hot", [(1, 3, 0.0), (2, 4, 0.34), (3, 5, 0.5)])
@pytest.mark.parametrize("tail, chunk", [(None, 90), (10, 90), (10, 20), (1, 100_000)])
def test_ring_equals_full_fold(orders, seed, size, hot, tail, chunk):
    """Tails that cannot be proven exact lead to the scan of all ranges."""
    rows = random_rows(seed, 400, ids=60, hot=hot)
    assert ring_ids(orders(*rows), size=size, tail_rows=tail, chunk_rows=chunk) == folds.ring(as_dicts(rows), size)


def ring_rows(ids):
    return [(i, 1, "P", 1, 10.0, 10.0, n + 1, "pending") for n, i in enumerate(ids)]


@pytest.mark.parametrize("ids", [
    ["A", "B"] * 200,                                                     # two ids in turn, for ever
    ["A"] * 400,                                                          # one id
    [f"N{n}" for n in range(40)] + ["N39", "N38"] * 150,                  # a settling run, then few ids that are in the ring
    [f"N{n}" for n in range(40)] + ["N39", "N3", "N38", "N5"] * 80,       # ... and some that are not
    [f"C{n % 7}" for n in range(400)],                                    # more ids than the ring holds, round and round
    ["A" if n % 2 else f"N{n}" for n in range(400)],                      # a hot id between new ones
])
@pytest.mark.parametrize("chunk", [30, 100_000])
def test_ring_without_a_settling_tail(orders, ids, chunk):
    rows = ring_rows(ids)
    assert ring_ids(orders(*rows), size=5, tail_rows=3, chunk_rows=chunk) == folds.ring(as_dicts(rows), 5)


def test_latest_run_is_found_over_borders(orders):
    """The run of different ids lies over several ranges, none of which holds it."""
    ids = ["A", "B"] * 20 + [f"N{n}" for n in range(60)] + ["N59", "N58"] * 20
    rows = ring_rows(ids)
    ranges = timeline._scanned(orders(*rows), ARRIVAL, 15)
    assert len(ranges) == 8 and all(r.settled is None for r in ranges)
    number, at = timeline._latest_run(ranges, 15)
    assert at == (55,) and ranges[number].first <= at
    assert ring_ids(orders(*rows), size=15, tail_rows=3) == folds.ring(as_dicts(rows), 15)


def test_ring_continues(orders):
    rows = random_rows(4, 60, ids=30)
    df = orders(*rows)
    before = timeline.timeline_ring(df.filter("seq < 40"), ARRIVAL, 6)
    after = timeline.timeline_ring(df.filter("seq >= 40"), ARRIVAL, 6, initial=before)
    assert [r["order_id"] for r in after.orderBy("ring_position").collect()] == folds.ring(as_dicts(rows), 6)
    idle = timeline.timeline_ring(df.filter("seq > 1000"), ARRIVAL, 6, initial=before)
    assert [r["order_id"] for r in idle.collect()] == [r["order_id"] for r in before.collect()]


def test_overlay(orders, spark):
    changes = spark.createDataFrame([("ORDER-002", "accepted")], "order_id string, new_status string")
    got = {r["order_id"]: r["status"] for r in timeline.overlay_status(orders(T1, T2, T3), changes).collect()}
    assert got == {"ORDER-001": "accepted", "ORDER-002": "accepted", "ORDER-003": "denied"}


# --- registry model -----------------------------------------------------------------------------------------


def test_needs_update(spark):
    kind = "struct<status:string,quantity:int,total:double>"
    base = ("pending", 5, 150.0)
    rows = [(None, base), (("accepted", 5, 150.0), base), (base, ("pending", 10, 300.0)), (base, ("pending", 5, 200.0)),
            (base, base)]
    df = spark.createDataFrame(rows, f"existing {kind}, incoming {kind}")
    assert [r[0] for r in df.select(registry.differs("existing", "incoming")).collect()] == [True, True, True, True, False]


def test_versions(orders):
    a = ("ORD", 1, "P", 1, 10.0, 10.0, 1)
    steps = registry.registry_steps(orders((*a, "pending"), (*a, "denied"), (*a, "denied"), (*a, "pending")), ARRIVAL)
    row = registry.registered_orders(steps).first()
    assert (row["status"], row["version"], row["quantity"]) == ("pending", 3, 1)
    history = [(r["version"], r["previous_status"], r["new_status"], r["update_reason"])
               for r in registry.order_updates(steps).orderBy("version").collect()]
    assert history == [(2, "accepted", "denied", "Status changed"), (3, "denied", "pending", "Status changed")]


def test_changed_quantity_updates_every_time(orders):
    first, later = ("ORD", 1, "P", 1, 10.0, 10.0, 1, "accepted"), ("ORD", 1, "P", 2, 10.0, 20.0, 2, "accepted")
    row = registry.registered_orders(registry.registry_steps(orders(first, later, later), ARRIVAL)).first()
    assert (row["version"], row["quantity"], row["total"], row["updated_at"]) == (3, 1, 10.0, 2)


def test_new_registered(orders):
    df = registry.new_registered(orders(T2, T2), F.col("seq") == 0).collect()
    assert [(r["status"], r["version"], r["validation_passed"]) for r in df] == [("accepted", 1, True), ("denied", 1, False)]


# --- monitor and store ----------------------------------------------------------------------------------------


def test_global_stats(spark):
    customers = spark.createDataFrame([(1, 100.0), (2, 50.0)], "customer_id int, total_spent double")
    products = spark.createDataFrame([("P1",), ("P2",)], "product_id string")
    registered = spark.createDataFrame([("accepted", 100.0), ("denied", 50.0), ("pending", 25.0)], "status string, total double")
    row = monitor.global_stats(customers, products, registered).first().asDict()
    assert row == {"customer_count": 2, "total_customers_spent": 150.0, "product_count": 2, "total_revenue_accepted": 100.0,
                   "registered_count": 3, "accepted_count": 1, "denied_count": 1, "pending_count": 1}
    empty = monitor.global_stats(customers.limit(0), products.limit(0), registered.limit(0)).first().asDict()
    assert set(empty.values()) == {0}


def test_overrides(spark, orders):
    wanted = spark.createDataFrame(
        [("ORDER-001", "accepted"), ("ORDER-002", "invalid"), ("GONE", "denied")], "order_id string, new_status string")
    got = {r["order_id"]: r for r in monitor.apply_overrides(wanted, orders(T1, T2, T3)).collect()}
    assert [got[k]["applied"] for k in ("ORDER-001", "ORDER-002", "GONE")] == [True, False, False]
    stored = monitor.overridden_rows(monitor.apply_overrides(wanted, orders(T1, T2, T3)), F.lit(9).cast("bigint")).collect()
    assert [(r["order_id"], r["status"], r["version"], r["validation_passed"]) for r in stored] == [
        ("ORDER-001", "accepted", 1, True)]


def test_status_cards_and_deltas(spark):
    cards = monitor.status_cards(spark.createDataFrame([("accepted",), ("accepted",), ("denied",), ("pending",)], "status string"))
    assert tuple(cards.first()) == (2, 1, 1, 4, "66.7%")
    assert monitor.status_cards(spark.createDataFrame([("pending",)], "status string")).first()["approval_rate"] == "N/A"
    changes = spark.createDataFrame(
        [("pending", "accepted"), ("pending", "denied"), ("denied", "pending"), ("accepted", "denied")],
        "old_status string, new_status string")
    assert tuple(monitor.status_deltas(changes).first()) == (1, 0, -1)


def test_searches(spark):
    customers = spark.createDataFrame([(n, float(n)) for n in range(1, 80)], "customer_id int, total_spent double")
    assert [r["customer_id"] for r in monitor.search_customers(customers).collect()] == list(range(79, 29, -1))
    assert [r["customer_id"] for r in monitor.search_customers(customers, "7").collect()] == [7]
    assert monitor.search_customers(customers, "7x").count() == 0
    assert monitor.search_customers(customers, "999").count() == 0
    assert monitor.filter_customers(customers, "abc").count() == 79
    assert monitor.filter_customers(customers, "7x").count() == 1
    products = spark.createDataFrame([("PROD-1", 5.0), ("PROD-12", 9.0), ("X-PROD-1", 7.0)], "product_id string, total_revenue double")
    assert [r["product_id"] for r in monitor.search_products(products, "prod-1").collect()] == ["PROD-12", "PROD-1"]
    assert monitor.filter_products(products, "prod-1").count() == 3


def test_merged_timeline_and_search(orders):
    stored = registry.new_registered(orders(("ORDER-002", 100, "PROD-Y", 3, 7.0, 21.0, 1, "pending")), F.lit(True))
    merged = {r["order_id"]: (r["status"], r["quantity"], r["unit_price"], r["total"])
              for r in monitor.timeline_with_status(orders(T1, T2, T3).drop("seq"), stored, 2).collect()}
    assert merged == {"ORDER-003": ("denied", 5, 50.0, 250.0), "ORDER-002": ("accepted", 3, 7.0, 75.0)}
    asked = orders(T1, T2, ("NONE", *T1[1:]))
    found = {r["order_id"]: r["source"] for r in monitor.search_orders(asked, stored, orders(T1, T2, T3)).collect()}
    assert found == {"ORDER-001": "timeline", "ORDER-002": "registered", "NONE": "not found"}


def test_store(orders):
    rows = [("order-1", 1, "P1", 1, 10.0, 10.0, 1000, "pending"), ("order-2", 1, "P2", 2, 10.0, 20.0, 2000, "pending"),
            ("order-3", 2, "P1", 1, 10.0, 10.0, 3000, "pending")]
    df = orders(*rows)
    assert tuple(store.store_stats(df, ARRIVAL).first()) == (3, 40.0, 3000)
    counts = {(r[0], r[1]): r[2] for r in store.store_breakdown(df).collect()}
    assert counts == {("customer", "1"): 2, ("customer", "2"): 1, ("product", "P1"): 2, ("product", "P2"): 1}
    assert [r["order_id"] for r in store.recent_orders(df, 2).collect()] == ["order-3", "order-2"]
    four = orders(*rows, ("order-4", 3, "P1", 1, 10.0, 10.0, 4000, "pending"))
    top = [(r["customer_id"], r["order_count"], r["rank"]) for r in store.top_by_count(four, "customer_id", 2).collect()]
    assert top == [(1, 2, 1), (2, 1, 2)]
    products = [(r["product_id"], r["order_count"]) for r in store.top_by_count(df, "product_id", 2).collect()]
    assert products == [("P1", 2), ("P2", 1)]
    assert store.average_order_value(df.filter("seq = 9")).first()[0] == 0.0
    assert round(store.average_order_value(df).first()[0], 6) == round(40 / 3, 6)


def test_constructor_and_summary(spark):
    asked = spark.createDataFrame(
        [(42, "PROD-001", 5, 10.99, None), (42, "PROD-001", 3, 10.99, "accepted"), (42, "PROD-001", 7, 15.50, None),
         (42, "PROD-001", 1, 99.99, None), (0, "PROD-001", 1, 1.0, None)],
        "customer_id int, product_id string, quantity int, unit_price double, status string")
    made, refused = store.new_orders(asked)
    rows = made.orderBy("total").collect()
    assert [(r["total"], r["status"]) for r in rows] == [
        (32.97, "accepted"), (54.95, "pending"), (99.99, "pending"), (108.5, "pending")]
    assert refused.count() == 1
    line = spark.createDataFrame([("123e4567-e89b", 42, 5, "P", 19.99, 99.95, "pending")],
                                 "order_id string, customer_id int, quantity int, product_id string, unit_price double, "
                                 "total double, status string").select(store.order_summary()).first()[0]
    assert line == "Order 123e4567: Customer 42 ordered 5 x P @ $19.99 = $99.95 [pending]"


def test_upsert_and_typed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(tuple(r) for r in store.upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    typed = store.typed(spark.createDataFrame([(None, None, None)], "n int, x double, t timestamp"), ["n"], ["x"], ["t"])
    assert tuple(typed.first()) == (0, 0.0, None)


def test_history_and_ranking(spark):
    updates = spark.createDataFrame([("A", 2), ("A", 3), ("B", 2)], "order_id string, version long")
    assert [r["version"] for r in monitor.history(updates, "A").collect()] == [3, 2]
    stats = spark.createDataFrame([("P1", 5.0), ("P2", None), ("P3", 9.0)], "product_id string, avg_quantity double")
    ranked = monitor.ranking(stats, "avg_quantity", "product_id").collect()
    assert [r["product_id"] for r in ranked] == ["P3", "P1", "P2"]
    lowest = monitor.ranking(stats, "avg_quantity", "product_id", descending=False, n=2).collect()
    assert [(r["product_id"], r["rank"]) for r in lowest] == [("P2", 1), ("P1", 2)]
    assert [r["product_id"] for r in monitor.ranking(stats, "product_id", "product_id").collect()] == ["P3", "P2", "P1"]
