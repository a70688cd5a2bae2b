"""Queries: projections, structural specs, business rules, filters, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.functions import rules, scalars, specs
from orderlens.operators import monitor, registry, store, timeline, views
from orderlens.plans import inputs as i
from orderlens.plans.aggregate_queries import DECISIONS, ORDER_LIST, decisions
from orderlens.plans.catalog import query
from orderlens.plans.checks import GATE, ORDER_ARRIVAL as OA, RULES, check
from orderlens.schemas import ORDER_COLUMNS
from orderlens.sources.feed import spread, table

# --- projections -------------------------------------------------------------------------------------


@query("prj_01_timeline_entry", check("gated", f"SELECT {ORDER_LIST} FROM gated"))
def _(spark, d):
    return views.timeline_entries(i.gated(spark, d))


@query("prj_02_new_orders", check("clean", f"""
SELECT customer_id, product_id, quantity, floor(unit_price * 100 + 0.5) / 100 AS unit_price,
       floor(quantity * unit_price * 100 + 0.5) / 100 AS total,
       CASE WHEN status = 'denied' THEN 'pending' ELSE status END AS status, TRUE AS fresh_uuid
FROM clean WHERE {GATE}"""))
def _(spark, d):
    # requests without a status get the default one
    requests = i.clean(spark, d).withColumn("status", F.when(F.col("status") != "denied", F.col("status")))
    made, _ = store.new_orders(requests)
    return made.select("customer_id", "product_id", "quantity", "unit_price", "total", "status",
                       F.col("order_id").rlike(specs.UUID_PATTERN).alias("fresh_uuid"))


@query("prj_03_typed_records", check("registered", """
SELECT l.order_id, coalesce(r.customer_id, 0) AS customer_id, r.product_id, coalesce(r.quantity, 0) AS quantity,
       coalesce(r.total, 0.0) AS total, r.status, r.registered_at, coalesce(r.version, 0) AS version
FROM (SELECT DISTINCT concat('ORD-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id FROM lineitem) l
LEFT JOIN registered r ON r.order_id = l.order_id"""))
def _(spark, d):
    stored = i.registered(spark, d, exact_price=False).withColumn("registered_at", F.timestamp_millis("registered_at"))
    ids = table(spark, d, "lineitem").select(F.concat_ws("-", F.lit("ORD"), "l_orderkey", "l_linenumber").alias("order_id")).distinct()
    rows = ids.join(stored, "order_id", "left").withColumn("total", F.col("total").cast("decimal(18,2)"))
    typed = store.typed(rows, ints=["customer_id", "quantity", "version"], decimals=["total"], times=["registered_at"])
    return typed.select("order_id", "customer_id", "product_id", "quantity", "total", "status", "registered_at", "version")


@query("prj_04_order_summary", check("clean", """
SELECT order_id, a1, a2, total, concat('Order ', substr(order_id, 1, 8), ': Customer ', CAST(customer_id AS VARCHAR), ' ordered ',
       CAST(quantity AS VARCHAR), ' x ', product_id, ' @ $', printf('%.2f', price), ' = $', printf('%.2f', total),
       ' [', status, ']') AS summary
FROM (SELECT *, floor(unit_price * 100 + 0.5) / 100 AS price FROM clean)"""))
def _(spark, d):
    return i.feed(spark, d).select("order_id", "a1", "a2", "total", store.order_summary().alias("summary"))


@query("prj_05_new_registered", check("gated", f"""
SELECT order_id, customer_id, product_id, quantity, unit_price, total,
       CASE WHEN {RULES} THEN 'accepted' ELSE 'denied' END AS status, timestamp AS registered_at,
       CAST(NULL AS BIGINT) AS updated_at, 1 AS version, {RULES} AS validation_passed FROM gated"""))
def _(spark, d):
    return registry.new_registered(i.gated(spark, d), rules.all_passed())


@query("prj_06_order_update", check("cupdates", "SELECT * FROM cupdates"))
def _(spark, d):
    return i.updates(spark, d)


@query("prj_07_initial_rows", check("customers", """
SELECT c_custkey AS customer_id, coalesce(total_orders, 0) AS total_orders, coalesce(total_spent, 0.0) AS total_spent
FROM customer LEFT JOIN customers ON c_custkey = customer_id"""))
def _(spark, d):
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    return views.zero_rows(known, "customer_id", i.customer_totals(spark, d), {"total_orders": 0, "total_spent": 0.0})


# --- structural specs -----------------------------------------------------------------------------------


def spec_rows(spec_query: str, failing: str):
    """SQL of a whole-table verdict: rows, valid rows, rows with violations."""
    return f"""SELECT count(*) AS row_count, count(*) FILTER ({failing}) AS valid_count,
                      count(*) FILTER (NOT ({failing})) AS invalid_count FROM {spec_query}"""


def verdict(df, spec):
    flagged = specs.check_rows(df, spec)
    return flagged.agg(
        F.count("*").alias("row_count"), F.count_if("valid").alias("valid_count"),
        F.count_if(F.size("violations") > 0).alias("invalid_count"))


@query("spec_01_order_gate", check("feed", f"SELECT order_id, a1, a2, total, {GATE} AS valid FROM feed"))
def _(spark, d):
    return i.feed(spark, d).select("order_id", "a1", "a2", "total", specs.order_spec().valid().alias("valid"))


STRICT = f"({GATE} AND regexp_full_match(order_id, '[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}') AND length(product_id) > 0)"


@query("spec_02_producer_gate", check("raw clean", f"""
SELECT order_id, a1, a2, total, {STRICT} AS valid FROM raw
UNION ALL SELECT order_id, a1, a2, total, {STRICT} FROM clean"""))
def _(spark, d):
    # UUID ids pass, the plain ids of the feed are refused
    both = i.uuid_feed(spark, d).unionByName(i.clean(spark, d))
    return both.select("order_id", "a1", "a2", "total", specs.strict_order_spec().valid().alias("valid"))


@query("spec_03_shared_gate", check("feed", spec_rows("feed", f"{GATE} AND order_id <> '' AND product_id <> ''")))
def _(spark, d):
    return verdict(i.feed(spark, d), specs.shared_order_spec())


@query("spec_04_customer_stats", check("customers", spec_rows(
    "customers", "customer_id > 0 AND total_orders >= 0 AND total_spent >= 0 AND first_order_timestamp > 0")))
def _(spark, d):
    return verdict(i.customers(spark, d), specs.customer_stats_spec())


@query("spec_05_product_stats", check("products", spec_rows(
    "products", "total_quantity >= 0 AND total_revenue >= 0 AND order_count >= 0 AND avg_quantity >= 0")))
def _(spark, d):
    return verdict(i.products(spark, d), specs.product_stats_spec())


@query("spec_06_timeline_entry", check("entries", spec_rows("entries", GATE)))
def _(spark, d):
    return verdict(i.entries(spark, d), specs.timeline_entry_spec())


@query("spec_07_processing_stats", check("gated", """
SELECT 1 AS row_count, 1 AS valid_count, 0 AS invalid_count FROM gated HAVING max(timestamp) > 0"""))
def _(spark, d):
    return verdict(views.processing_stats(i.feed(spark, d), "query-processor"), specs.processing_stats_spec())


@query("spec_08_registered_order", check("cregistered", spec_rows(
    "cregistered", "version > 0 AND registered_at > 0 AND quantity > 0 AND total > 0 AND order_id <> ''")))
def _(spark, d):
    return verdict(i.registered(spark, d), specs.registered_order_spec())


@query("spec_09_order_update", check("cupdates", spec_rows("cupdates", "version > 0 AND updated_at > 0") + """
UNION ALL SELECT 1, 1, 0"""))
def _(spark, d):
    stats = registry.validation_stats(i.feed(spark, d), "registry-processor")
    return verdict(i.updates(spark, d), specs.order_update_spec()).unionByName(
        verdict(stats, specs.validation_stats_spec()))


@query("spec_10_explain_violations", check("feed", """
SELECT order_id, a1, a2, concat_ws('; ',
       CASE WHEN coalesce(customer_id > 0, FALSE) THEN NULL ELSE 'customer_id: must be positive' END,
       CASE WHEN coalesce(quantity > 0, FALSE) THEN NULL ELSE 'quantity: must be positive' END,
       CASE WHEN coalesce(unit_price > 0, FALSE) THEN NULL ELSE 'unit_price: must be positive' END,
       CASE WHEN coalesce(total > 0, FALSE) THEN NULL ELSE 'total: must be positive' END) AS violations
FROM feed WHERE NOT """ + GATE))
def _(spark, d):
    spec = specs.order_spec()
    return i.feed(spark, d).filter(~spec.valid()).select("order_id", "a1", "a2", spec.explain().alias("violations"))


@query("spec_10_violation_counts", check("clean", """
SELECT 'order_id: must be a lower-case UUID' AS violation, count(*) AS row_count FROM clean
UNION ALL SELECT 'customer_id: must be positive', count(*) FROM clean WHERE NOT customer_id > 0 HAVING count(*) > 0
UNION ALL SELECT 'total: must be positive', count(*) FROM clean WHERE NOT total > 0 HAVING count(*) > 0"""))
def _(spark, d):
    return specs.violation_counts(i.clean(spark, d), specs.strict_order_spec())


# --- business rules -------------------------------------------------------------------------------------

_TOTAL = "CAST(total AS VARCHAR)"
_QTY = "CAST(quantity AS VARCHAR)"
# fixed values: rule names and messages
RULE_SQL = [
    ("minimum-quantity", "quantity >= 1", f"concat('Quantity must be at least 1, got: ', {_QTY})"),
    ("maximum-quantity", "quantity <= 1000", f"concat('Quantity exceeds maximum of 1000, got: ', {_QTY})"),
    ("minimum-total", "total >= 1.0", f"concat('Total must be at least $1.0, got: $', {_TOTAL})"),
    ("maximum-total", "total <= 100000.0", f"concat('Total exceeds maximum of $100000.0, got: $', {_TOTAL})"),
    ("price-consistency", "abs(total - quantity * unit_price) <= 0.01",
     f"concat('Total mismatch. Expected: $', CAST(quantity * unit_price AS VARCHAR), ', got: $', {_TOTAL})"),
    ("valid-status", "status IN ('pending', 'accepted', 'denied')", "concat('Invalid status: ', status)"),
    ("valid-customer-id", "customer_id > 0", "concat('Invalid customer ID: ', CAST(customer_id AS VARCHAR))"),
    ("valid-product-id", "length(product_id) > 0", "'Product ID cannot be empty'"),
]


def _rule_query(number: int, name: str, holds: str, message: str) -> None:
    @query(f"rul_{number:02d}_{name.replace('-', '_')}", check("feed", f"""
SELECT order_id, a1, a2, total, '{name}' AS rule_name, {holds} AS passed,
       CASE WHEN {holds} THEN NULL ELSE {message} END AS message FROM feed"""))
    def _(spark, d):
        result = rules.default_rules()[number - 1].result()
        return i.feed(spark, d).select("order_id", "a1", "a2", "total", result.alias("r")).select(
            "order_id", "a1", "a2", "total", "r.*")


for _number, (_name, _holds, _message) in enumerate(RULE_SQL, 1):
    _rule_query(_number, _name, _holds, _message)

_MESSAGES = ", ".join(f"CASE WHEN {h} THEN NULL ELSE {m} END" for _, h, m in RULE_SQL)
_NAMES = ", ".join(f"CASE WHEN {h} THEN NULL ELSE '{n}' END" for n, h, _ in RULE_SQL)


@query("rul_09_validate_order", check("feed", f"""
SELECT order_id, a1, a2, total, {RULES} AS passed, 8 AS rule_count,
       CASE WHEN {RULES} THEN NULL ELSE concat('Validation failed: ', concat_ws(', ', {_MESSAGES})) END AS message
FROM feed"""))
def _(spark, d):
    return rules.validate_orders(i.feed(spark, d)).select(
        "order_id", "a1", "a2", "total", "validation_result.passed",
        F.size("validation_result.rules").alias("rule_count"), "validation_result.message")


@query("rul_10_failure_summary", check("feed", f"""
SELECT order_id, a1, a2, total, concat_ws(',', {_NAMES}) AS failed_rules,
       CASE WHEN {RULES} THEN NULL ELSE concat('Failed rules: ', concat_ws(', ', {_NAMES})) END AS summary FROM feed"""))
def _(spark, d):
    return rules.validate_orders(i.feed(spark, d)).select(
        "order_id", "a1", "a2", "total", F.array_join(rules.stored_failed_rules(), ",").alias("failed_rules"),
        rules.failure_summary().alias("summary"))


@query("rul_11_failures_per_rule", check("gated", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS rule_name, count(*) FILTER (NOT ({h})) AS failures FROM gated" for n, h, _ in RULE_SQL
) + ") WHERE failures > 0"))
def _(spark, d):
    return rules.failures_per_rule(i.feed(spark, d))


@query("rul_12_producer_check", check("feed", """
SELECT order_id, a1, a2, total, abs(quantity * unit_price - total) < 0.02 AS business_valid,
       CASE WHEN abs(quantity * unit_price - total) < 0.02 THEN '' ELSE 'Total must equal quantity * unit-price' END AS errors
FROM feed"""))
def _(spark, d):
    return rules.producer_check(i.feed(spark, d)).select(
        "order_id", "a1", "a2", "total", "business_valid", F.array_join("business_errors", ",").alias("errors"))


@query("rul_13_rule_constants", check("gated", """
SELECT count(*) AS orders, count(*) FILTER (quantity BETWEEN 5 AND 40 AND total BETWEEN 1000.0 AND 50000.0
       AND abs(total - quantity * unit_price) <= 0.1) AS approved FROM gated"""))
def _(spark, d):
    config = rules.RuleConfig(min_quantity=5, max_quantity=40, min_total=1000.0, max_total=50000.0, price_tolerance=0.1)
    verdict = rules.all_passed(rules.default_rules(config))
    return i.gated(spark, d).agg(F.count("*").alias("orders"), F.count_if(verdict).alias("approved"))


@query("rul_14_validate_command", check("feed", f"""
SELECT order_id, a1, a2, total, CASE WHEN NOT {GATE} THEN 'malformed' WHEN {RULES} THEN 'approved'
       ELSE 'rejected' END AS outcome FROM feed"""))
def _(spark, d):
    return i.feed(spark, d).select("order_id", "a1", "a2", "total", rules.outcome().alias("outcome"))


@query("udf_01_extended_rules", check("gated", """
SELECT 'even-quantity' AS rule_name, count(*) FILTER (quantity % 2 <> 0) AS failures FROM gated
UNION ALL SELECT 'maximum-total', count(*) FILTER (total > 100000.0) FROM gated"""))
def _(spark, d):
    even_quantity = rules.Rule("even-quantity", F.col("quantity") % 2 == 0, F.lit("Quantity must be even"))
    return rules.failures_per_rule(i.feed(spark, d), [rules.default_rules()[3], even_quantity])


# --- filters and searches --------------------------------------------------------------------------------


@query("flt_01_orders_by_customer", check("latest_by_id", f"SELECT {ORDER_LIST} FROM latest_by_id WHERE customer_id = 42"))
def _(spark, d):
    unique = views.last_arrival_per_order(i.feed(spark, d), i.ORDER_ARRIVAL)
    return monitor.lookup(unique, "customer_id", 42).select(*ORDER_COLUMNS)


@query("flt_02_orders_by_product", check("latest_by_id", f"SELECT {ORDER_LIST} FROM latest_by_id WHERE product_id = 'PROD-7'"))
def _(spark, d):
    unique = views.last_arrival_per_order(i.feed(spark, d), i.ORDER_ARRIVAL)
    return monitor.lookup(unique, "product_id", "PROD-7").select(*ORDER_COLUMNS)


@query("flt_03_registered_by_status", check("cregistered", """
SELECT * FROM cregistered WHERE status = 'denied' ORDER BY order_id LIMIT 100"""))
def _(spark, d):
    return monitor.orders_by_status(i.registered(spark, d), "denied")


@query("flt_04_customer_search", check("customers", """
SELECT 'blank' AS search, * FROM (SELECT * FROM customers ORDER BY total_spent DESC, customer_id LIMIT 50)
UNION ALL SELECT '77', * FROM customers WHERE customer_id = 77"""))
def _(spark, d):
    stats = i.customers(spark, d)
    found = [monitor.search_customers(stats, q).withColumn("search", F.lit(q or "blank")) for q in ("", "77", "7x")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("flt_05_product_search", check("products", """
SELECT 'blank' AS search, * FROM (SELECT * FROM products ORDER BY total_revenue DESC, product_id LIMIT 50)
UNION ALL SELECT 'prod-1', * FROM products WHERE starts_with(product_id, 'PROD-1')"""))
def _(spark, d):
    stats = i.products(spark, d)
    found = [monitor.search_products(stats, q).withColumn("search", F.lit(q or "blank")) for q in ("", "prod-1")]
    return found[0].unionByName(found[1])


@query("flt_06_product_filter", check("products", "SELECT * FROM products WHERE contains(product_id, 'D-12')"))
def _(spark, d):
    return monitor.filter_products(i.products(spark, d), "d-12")


@query("flt_07_customer_filter", check("customers", """
SELECT 'text' AS search, * FROM customers UNION ALL SELECT '12', * FROM customers WHERE customer_id = 12"""))
def _(spark, d):
    stats = i.customers(spark, d)
    by_text = monitor.filter_customers(stats, "text").withColumn("search", F.lit("text"))
    return by_text.unionByName(monitor.filter_customers(stats, "12 ").withColumn("search", F.lit("12")))


@query("flt_08_order_id_format", check("raw clean", """
SELECT valid_id, count(*) AS row_count FROM (
  SELECT regexp_full_match(order_id, '[0-9a-fA-F]{1,16}(-[0-9a-fA-F]{1,16}){4}') AND length(order_id) <= 36 AS valid_id
  FROM (SELECT order_id FROM raw UNION ALL SELECT order_id FROM clean)) GROUP BY valid_id"""))
def _(spark, d):
    ids = i.uuid_feed(spark, d).select("order_id").unionByName(i.clean(spark, d).select("order_id"))
    return monitor.check_lookup_ids(ids).groupBy("valid_id").agg(F.count("*").alias("row_count"))


@query("flt_09_status_subsets", check("gated", """
SELECT order_id, a1, a2, total, status FROM gated WHERE status IN ('accepted', 'denied')"""))
def _(spark, d):
    rows = i.gated(spark, d).select("order_id", "a1", "a2", "total", "status")
    return monitor.with_status(rows, "accepted").unionByName(monitor.with_status(rows, "denied"))


@query("flt_10_awaiting_decision", check("entries", "SELECT * FROM entries WHERE status = 'pending'"))
def _(spark, d):
    return monitor.awaiting_decision(i.entries(spark, d))


# --- joins --------------------------------------------------------------------------------------------------


@query("joi_01_timeline_with_status", check("merged", "SELECT * FROM merged", n=1000))
def _(spark, d):
    return monitor.timeline_with_status(i.entries(spark, d), i.registered(spark, d), 1000)


@query("joi_02_order_search", check("feed recent cregistered", """
SELECT q.order_id, coalesce(r.customer_id, t.customer_id) AS customer_id, coalesce(r.product_id, t.product_id) AS product_id,
       coalesce(r.quantity, t.quantity) AS quantity, coalesce(r.unit_price, t.unit_price) AS unit_price,
       coalesce(r.total, t.total) AS total, coalesce(r.status, t.status) AS status,
       CASE WHEN r.order_id IS NOT NULL THEN 'registered' WHEN t.order_id IS NOT NULL THEN 'timeline' ELSE 'not found' END AS source
FROM (SELECT DISTINCT order_id FROM feed) q LEFT JOIN cregistered r ON q.order_id = r.order_id
LEFT JOIN recent t ON q.order_id = t.order_id"""))
def _(spark, d):
    return monitor.search_orders(i.feed(spark, d), i.registered(spark, d), i.entries(spark, d))


@query("joi_03_whereabouts", check("feed recent cregistered", """
SELECT q.order_id, r.order_id IS NOT NULL AS in_registered, t.order_id IS NOT NULL AS in_timeline,
       r.status AS registered_status, r.version AS registered_version, t.status AS timeline_status, t.total AS timeline_total
FROM (SELECT DISTINCT order_id FROM feed) q LEFT JOIN cregistered r ON q.order_id = r.order_id
LEFT JOIN recent t ON q.order_id = t.order_id"""))
def _(spark, d):
    return monitor.whereabouts(i.feed(spark, d), i.registered(spark, d), i.entries(spark, d))


@query("joi_04_overrides", check("gated recent", f"""
SELECT order_id, new_status, ok AS applied, CASE WHEN ok THEN customer_id END AS customer_id,
       CASE WHEN ok THEN product_id END AS product_id, CASE WHEN ok THEN quantity END AS quantity,
       CASE WHEN ok THEN unit_price END AS unit_price, CASE WHEN ok THEN total END AS total,
       CASE WHEN ok THEN 1 END AS version, CASE WHEN ok THEN new_status = 'accepted' END AS validation_passed
FROM (SELECT d.order_id, d.new_status, t.customer_id, t.product_id, t.quantity, t.unit_price, t.total,
             t.order_id IS NOT NULL AND d.new_status IN ('accepted', 'denied') AS ok
      FROM ({DECISIONS}) d LEFT JOIN recent t ON d.order_id = t.order_id)"""))
def _(spark, d):
    return monitor.apply_overrides(decisions(spark, d), i.entries(spark, d))


@query("joi_05_incoming_with_existing", check("csteps", """
SELECT order_id, a1, a2, timestamp, status, total, quantity,
       CASE WHEN earlier = 1 THEN 'accepted' WHEN earlier > 1 THEN last_status END AS existing_status, CAST(existing_version AS BIGINT) AS existing_version
FROM (SELECT *, count(*) FILTER (timestamp < 946684800000) OVER same AS earlier,
             arg_max(status, rn) FILTER (timestamp < 946684800000) OVER same AS last_status,
             max(version) FILTER (timestamp < 946684800000) OVER same AS existing_version
      FROM csteps WINDOW same AS (PARTITION BY order_id)) WHERE timestamp >= 946684800000"""))
def _(spark, d):
    # the registry after the years before 2000, looked up by the orders that follow
    orders = registry.approved(i.clean(spark, d))
    cut = 946_684_800_000
    stored = registry.registered_orders(
        registry.registry_steps(orders.filter(F.col("timestamp") < cut), i.ORDER_ARRIVAL))
    known = stored.select("order_id", F.col("status").alias("existing_status"), F.col("version").alias("existing_version"))
    return orders.filter(F.col("timestamp") >= cut).join(known, "order_id", "left").select(
        "order_id", "a1", "a2", "timestamp", "status", "total", "quantity", "existing_status", "existing_version")


@query("joi_06_unseen_orders", check("feed recent", """
SELECT order_id, a1, a2, total FROM feed WHERE order_id NOT IN (SELECT order_id FROM recent)"""))
def _(spark, d):
    return timeline.unseen_orders(i.feed(spark, d), i.entries(spark, d)).select(
        "order_id", "a1", "a2", "total")


# --- scalar functions --------------------------------------------------------------------------------------


@query("sca_01_round", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(l_extendedprice * l_discount * 10 + 0.5) / 10 AS d1,
       floor(l_extendedprice * l_tax * 1000 + 0.5) / 1000 AS d3, floor((l_discount - l_tax) * 100 * 1 + 0.5) / 1 AS d0
FROM lineitem""")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.round_half_up(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("d1"),
        scalars.round_half_up(F.col("l_extendedprice") * F.col("l_tax"), 3).alias("d3"),
        scalars.round_half_up((F.col("l_discount") - F.col("l_tax")) * 100, 0).alias("d0"))


@query("sca_02_percentage", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_tax = 0 THEN 0.0 ELSE floor(l_discount / l_tax * 100 * 100 + 0.5) / 100 END AS share FROM lineitem""")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.percentage("l_discount", "l_tax").alias("share"))


@query("sca_03_ranges", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity >= 10 AND l_quantity <= 20 AS in_range, l_tax > 0 AS positive
FROM lineitem""")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.within_range("l_quantity", 10, 20).alias("in_range"), scalars.valid_positive("l_tax").alias("positive"))


def _cut(n):
    inner = f"substr(text, 1, {n})" if n <= 3 else f"concat(substr(text, 1, {n - 3}), '...')"
    return f"CASE WHEN length(text) <= {n} THEN text ELSE {inner} END"


@query("sca_04_truncate", f"SELECT doc_id, {_cut(80)} AS t80, {_cut(3)} AS t3 FROM documents")
def _(spark, d):
    return documents(spark, d).select(
        "doc_id", scalars.truncate("text", 80).alias("t80"), scalars.truncate("text", 3).alias("t3"))


@query("sca_05_case_names", """
SELECT conv_id AS "conv-id", turn, role, replace(text, '-', '_') AS "snake-text", replace(text, '_', '-') AS "kebab-text"
FROM conversations""")
def _(spark, d):
    rows = table(spark, d, "conversations").select(
        "conv_id", "turn", "role", scalars.kebab_to_snake("text").alias("snake_text"),
        scalars.snake_to_kebab("text").alias("kebab_text"))
    return scalars.kebab_columns(rows)


_TOKENS = "list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: {})"


def documents(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def tokens():
    return F.split("text", r"[ \t\n\x0B\f\r]+")


@query("sca_06_valid_email", f"""
SELECT doc_id, len({_TOKENS.format("regexp_full_match(x, '.+@.+[.].+')")}) AS emails FROM documents""")
def _(spark, d):
    return documents(spark, d).select(
        "doc_id", F.size(F.filter(tokens(), scalars.valid_email)).cast("bigint").alias("emails"))


@query("sca_07_parse_numbers", f"""
SELECT doc_id, len(ints) AS int_count, coalesce(list_sum(ints), 0) AS int_sum, doubles AS double_count FROM (
  SELECT doc_id, list_filter(list_transform({_TOKENS.format("regexp_full_match(x, '[+-]?[0-9]+')")},
                             lambda x: TRY_CAST(x AS INT)), lambda x: x IS NOT NULL) AS ints,
         len({_TOKENS.format("regexp_full_match(x, '[+-]?(NaN|Infinity|([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)')")}) AS doubles
  FROM documents)""")
def _(spark, d):
    ints = F.array_compact(F.transform(tokens(), scalars.try_parse_int))
    doubles = F.array_compact(F.transform(tokens(), scalars.try_parse_double))
    return documents(spark, d).select(
        "doc_id", F.size(ints).cast("bigint").alias("int_count"),
        F.aggregate(ints, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("int_sum"),
        F.size(doubles).cast("bigint").alias("double_count"))


def event_props(spark, d):
    props = F.from_json("props", "map<string,bigint>")
    # a map with a null in it: the value of one kind of event is left out
    extra = F.create_map(F.lit("value"), F.when(F.col("event_type") != "error", F.col("event_id")))
    return table(spark, d, "events").select("event_id", "event_type", F.map_concat(props, extra).alias("m"))


@query("sca_08_safe_get", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type <> 'error' THEN event_id END AS value,
       -1 AS absent FROM events""")
def _(spark, d):
    minus_one = -1
    return event_props(spark, d).select(
        "event_id", scalars.safe_get("m", "k", minus_one).alias("k"),
        scalars.safe_get("m", "value", minus_one).alias("value"),
        scalars.safe_get("m", "no-such-key", minus_one).alias("absent"))


@query("sca_09_filter_nulls", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN 'k,value' ELSE 'k' END AS keys FROM events""")
def _(spark, d):
    kept = scalars.filter_null_values("m")
    return event_props(spark, d).select("event_id", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys"))


@query("sca_10_redact", """
SELECT conv_id, turn, role, '***REDACTED***' AS text FROM conversations""")
def _(spark, d):
    return scalars.redact_columns(table(spark, d, "conversations"), ["text", "password", "token"])


@query("sca_10_redact_map", """
SELECT event_id, '***REDACTED***' AS k, event_type AS kind FROM events""")
def _(spark, d):
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("kind"), F.col("event_type"))
    hidden = scalars.redact_map("m", ["k", "api-key"])
    return table(spark, d, "events").select("event_id", m.alias("m")).select(
        "event_id", hidden["k"].alias("k"), hidden["kind"].alias("kind"))


@query("sca_11_time", """
SELECT event_id, epoch_us(ts) // 1000 AS millis, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
       CASE WHEN epoch_us(ts) // 1000 % 1000 = 0 THEN '' ELSE concat('.', strftime(ts, '%g')) END, 'Z') AS iso,
       TRUE AS in_the_past FROM events""")
def _(spark, d):
    millis = scalars.epoch_millis("ts")
    return table(spark, d, "events").select(
        "event_id", millis.alias("millis"), scalars.iso_instant(millis).alias("iso"),
        (millis < scalars.now_millis()).alias("in_the_past"))


@query("sca_12_surrogate_ids", """
SELECT c_mktsegment, count(*) AS row_count, count(*) AS uuid_count, count(*) AS order_id_count FROM customer GROUP BY 1""")
def _(spark, d):
    keyed = table(spark, d, "customer").select("c_mktsegment", F.uuid().alias("u"), scalars.order_id_text().alias("o"))
    return keyed.groupBy("c_mktsegment").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("u").rlike(specs.UUID_PATTERN)).alias("uuid_count"),
        F.count_if(F.col("o").rlike("^ORDER-[0-9]{13}-[0-9]{1,4}$")).alias("order_id_count"))
