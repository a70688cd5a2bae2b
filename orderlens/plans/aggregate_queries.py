"""Queries: aggregations, order-dependent folds, registry, rankings, de-duplication, timeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.functions.scalars import average, iso_instant
from orderlens.functions.specs import order_spec
from orderlens.operators import monitor, registry, store, timeline, views
from orderlens.operators.ordering import group_in_chunks
from orderlens.plans import inputs as i
from orderlens.plans.catalog import query
from orderlens.plans.checks import GATE, RULES, check, money, ORDER_ARRIVAL as OA
from orderlens.schemas import ORDER_COLUMNS
from orderlens.sources.feed import CUSTOMER_ARRIVAL, ORDER_ARRIVAL, table

ORDER_LIST = ", ".join(ORDER_COLUMNS)

# --- aggregations -----------------------------------------------------------------------------------


@query("agg_01_customer_stats", check("customers", "SELECT * FROM customers"))
def _(spark, d):
    return i.customers(spark, d)


@query("agg_02_product_stats", check("products", "SELECT * FROM products"))
def _(spark, d):
    return i.products(spark, d)


@query("agg_03_average_quantity", check("gated", """
SELECT p_partkey, coalesce(n, 0) AS order_count, coalesce(q / n, 0.0) AS avg_quantity
FROM part LEFT JOIN (SELECT product_id, count(*) AS n, CAST(sum(quantity) AS DOUBLE) AS q FROM gated GROUP BY product_id)
ON product_id = concat('PROD-', CAST(p_partkey AS VARCHAR))"""))
def _(spark, d):
    stats = i.products(spark, d).select("product_id", "total_quantity", "order_count")
    parts = table(spark, d, "part").select("p_partkey", F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"))
    joined = parts.join(stats, "product_id", "left")
    return joined.select("p_partkey", F.coalesce("order_count", F.lit(0)).alias("order_count"),
                         average("total_quantity", "order_count").alias("avg_quantity"))


@query("agg_04_processing_metrics", check("feed", f"""
SELECT 'query-processor' AS processor_id, count(*) FILTER ({GATE}) AS processed_count,
       count(*) FILTER (NOT {GATE}) AS error_count, max(timestamp) FILTER ({GATE}) AS last_processed_timestamp
FROM feed"""))
def _(spark, d):
    return views.processing_stats(i.feed(spark, d), "query-processor").drop("total_revenue_accepted")


@query("agg_05_accepted_revenue", check(
    "gated", f"SELECT {money('total')} AS total_revenue_accepted FROM gated WHERE status = 'accepted'"))
def _(spark, d):
    return i.gated(spark, d).agg(views.accepted_revenue().alias("total_revenue_accepted"))


@query("agg_06_all_views", check("customers products ring", f"""
SELECT 'customers' AS view, CAST(customer_id AS VARCHAR) AS key, total_orders AS row_count, total_spent AS amount,
       last_order_timestamp AS last_timestamp FROM customers
UNION ALL SELECT 'products', product_id, order_count, total_revenue, last_order_timestamp FROM products
UNION ALL SELECT 'timeline', order_id, 1, total, timestamp FROM ring
UNION ALL SELECT 'processing', 'query-processor', count(*),
                 (SELECT {money('total')} FROM gated WHERE status = 'accepted'), max(timestamp) FROM gated"""))
def _(spark, d):
    feed = i.feed(spark, d)
    ring = timeline.timeline_ring(views.gated(feed), i.TIMELINE_ARRIVAL)
    return views.views_as_rows(views.all_views(feed, CUSTOMER_ARRIVAL, ring, "query-processor"))


@query("agg_07_view_summary", check("customers products ring", f"""
SELECT (SELECT count(*) FROM customers) AS customer_count, (SELECT count(*) FROM products) AS product_count,
       (SELECT count(*) FROM ring) AS timeline_size,
       count(*) FILTER ({GATE}) AS processed_count, count(*) FILTER (NOT {GATE}) AS error_count FROM feed"""))
def _(spark, d):
    feed = i.feed(spark, d)
    valid = views.gated(feed)
    # the sizes need only the distinct keys, not the statistics
    return views.view_sizes(
        valid.select("customer_id").distinct(), valid.select("product_id").distinct(),
        timeline.timeline_ring(valid, i.TIMELINE_ARRIVAL), views.processing_stats(feed, "query-processor"))


VALIDATION_STATS = f"""
SELECT 'registry-processor' AS processor_id, count(*) FILTER ({GATE}) AS total_validated,
       count(*) FILTER ({GATE} AND {RULES}) AS total_approved,
       count(*) FILTER (NOT ({GATE} AND {RULES})) AS total_rejected, 0 AS undecodable,
       max(timestamp) FILTER ({GATE}) AS timestamp FROM feed"""


@query("agg_08_validation_stats", check("feed", VALIDATION_STATS))
def _(spark, d):
    return registry.validation_stats(i.feed(spark, d), "registry-processor")


DECISIONS = """
SELECT order_id, CASE length(order_id) % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'denied' ELSE 'shipped' END AS new_status
FROM (SELECT DISTINCT order_id FROM gated)"""


def decisions(spark, d):
    """Manual decisions on every order of the feed."""
    by_length = F.length("order_id") % 3
    return i.gated(spark, d).select("order_id").distinct().withColumn(
        "new_status", F.when(by_length == 0, "accepted").when(by_length == 1, "denied").otherwise("shipped"))


@query("agg_09_override_counters", check("feed gated", f"""
SELECT 'monitor-api' AS processor_id, count(*) AS total_validated,
       count(*) FILTER (new_status = 'accepted') AS total_approved,
       count(*) FILTER (new_status = 'denied') AS total_rejected
FROM ({DECISIONS}) WHERE new_status IN ('accepted', 'denied')
UNION ALL SELECT processor_id, total_validated, total_approved, total_rejected FROM ({VALIDATION_STATS})"""))
def _(spark, d):
    valid = decisions(spark, d).filter(F.col("new_status").isin("accepted", "denied"))
    automatic = registry.validation_stats(i.feed(spark, d), "registry-processor").drop("undecodable", "timestamp")
    return registry.override_counters(valid).unionByName(automatic)


@query("agg_10_global_stats", check("customers products cregistered", f"""
SELECT (SELECT count(*) FROM customers) AS customer_count,
       (SELECT {money('total_spent')} FROM customers) AS total_customers_spent,
       (SELECT count(*) FROM products) AS product_count,
       {money("CASE WHEN status = 'accepted' THEN total END")} AS total_revenue_accepted,
       count(*) AS registered_count, count(*) FILTER (status = 'accepted') AS accepted_count,
       count(*) FILTER (status = 'denied') AS denied_count, count(*) FILTER (status = 'pending') AS pending_count
FROM cregistered"""))
def _(spark, d):
    return monitor.global_stats(i.customer_totals(spark, d), i.gated(spark, d).select("product_id").distinct(),
                                i.registered(spark, d))


@query("agg_11_status_cards", check("merged", """
SELECT a AS accepted, b AS denied, c AS pending, a + b + c AS total,
       CASE WHEN a + b > 0 THEN concat(CAST(CAST(floor(100.0 * a / (a + b) * 10 + 0.5) / 10 AS DECIMAL(10,1)) AS VARCHAR), '%')
            ELSE 'N/A' END AS approval_rate
FROM (SELECT count(*) FILTER (status = 'accepted') AS a, count(*) FILTER (status = 'denied') AS b,
             count(*) FILTER (status = 'pending') AS c FROM merged)"""))
def _(spark, d):
    return monitor.status_cards(monitor.timeline_with_status(i.entries(spark, d), i.registered(spark, d)))


@query("agg_12_store_stats", check("feed", f"""
SELECT 'customer' AS dimension, CAST(customer_id AS VARCHAR) AS key, count(*) AS order_count, CAST(NULL AS DOUBLE) AS total_value,
       CAST(NULL AS BIGINT) AS last_updated FROM feed GROUP BY customer_id
UNION ALL SELECT 'product', product_id, count(*), NULL, NULL FROM feed GROUP BY product_id
UNION ALL SELECT 'all', 'total', count(*), {money('total')}, max(timestamp) FROM feed"""))
def _(spark, d):
    feed = i.feed(spark, d)
    totals = store.store_stats(feed, ORDER_ARRIVAL).select(
        F.lit("all").alias("dimension"), F.lit("total").alias("key"), F.col("total").alias("order_count"),
        "total_value", "last_updated")
    return store.store_breakdown(feed).unionByName(totals, allowMissingColumns=True)


@query("agg_13_average_order_value", check(
    "feed", f"SELECT {money('total')} / count(*) AS average_order_value FROM feed"))
def _(spark, d):
    return store.average_order_value(i.feed(spark, d))


@query("agg_14_count_orders", "SELECT count(*) AS order_count FROM orders")
def _(spark, d):
    return table(spark, d, "orders").agg(F.count("*").alias("order_count"))


@query("agg_15_raw_customer_totals", check("clean", """
SELECT customer_id, count(*) AS order_count, sum(CAST(total AS DECIMAL(18,2))) AS total_spent
FROM clean GROUP BY customer_id"""))
def _(spark, d):
    return store.raw_customer_totals(i.clean(spark, d))


@query("agg_16_batch_outcome", check("feed", f"""
SELECT year(make_timestamp(timestamp * 1000)) AS batch, count(*) AS total, count(*) FILTER ({GATE}) AS success,
       count(*) FILTER (NOT {GATE}) AS errors FROM feed GROUP BY 1"""))
def _(spark, d):
    # one batch per year of the feed
    valid = order_spec().valid()
    batch = F.substring(iso_instant("timestamp"), 1, 4).cast("bigint")
    return i.feed(spark, d).groupBy(batch.alias("batch")).agg(
        F.count("*").alias("total"), F.count_if(valid).alias("success"), F.count_if(~valid).alias("errors"))


@query("agg_17_producer_metrics", check("feed", f"""
SELECT topic, count(*) FILTER ({GATE}) AS sent, count(*) FILTER (NOT {GATE}) AS failed,
       max(timestamp) FILTER ({GATE}) AS last_sent
FROM feed, (VALUES ('orders'), ('registry')) AS t(topic) GROUP BY topic"""))
def _(spark, d):
    from orderlens.sources.topics import ORDERS, REGISTRY, fan_out
    valid = order_spec().valid()
    deliveries = i.feed(spark, d).select(valid.alias("delivered"), "timestamp")
    # aggregated per outcome first, fanned out afterwards: the topics get the same messages
    counted = deliveries.agg(
        F.count_if("delivered").alias("sent"), F.count_if(~F.col("delivered")).alias("failed"),
        F.max(F.when(F.col("delivered"), F.col("timestamp"))).alias("last_sent"))
    return fan_out(counted, [ORDERS, REGISTRY])


@query("agg_18_group_rows", """
SELECT conv_id, CAST((rn - 1) // 100 AS BIGINT) AS chunk, count(*) AS row_count, string_agg(piece, '|' ORDER BY rn) AS items
FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn,
             concat(CAST(turn AS VARCHAR), ':', role, ':', CAST(length(text) AS VARCHAR)) AS piece FROM conversations)
GROUP BY conv_id, (rn - 1) // 100""")
def _(spark, d):
    grouped = group_in_chunks(table(spark, d, "conversations"), "conv_id", ["turn", "role", "text"], 100)
    pieces = F.transform("items", lambda r: F.concat(
        r["turn"].cast("string"), F.lit(":"), r["role"], F.lit(":"), F.length(r["text"]).cast("string")))
    return grouped.select("conv_id", "chunk", "row_count", F.array_join(pieces, "|").alias("items"))


@query("agg_19_metric_counters", """
SELECT concat('events.', event_type) AS metric, count(*) AS value FROM events GROUP BY 1""")
def _(spark, d):
    deltas = table(spark, d, "events").select(
        F.concat(F.lit("events."), F.col("event_type")).alias("metric"), F.lit(1).cast("bigint").alias("delta"))
    return store.counters(deltas)


@query("agg_20_status_deltas", check("cupdates", """
SELECT count(*) FILTER (o = 'pending' AND n = 'accepted') - count(*) FILTER (o = 'accepted' AND n = 'pending') AS accepted_delta,
       count(*) FILTER (o = 'pending' AND n = 'denied') - count(*) FILTER (o = 'denied' AND n = 'pending') AS denied_delta,
       count(*) FILTER (o <> 'pending' AND n = 'pending') - count(*) FILTER (o = 'pending' AND n <> 'pending') AS pending_delta
FROM (SELECT previous_status AS o, new_status AS n FROM cupdates)"""))
def _(spark, d):
    return monitor.status_deltas(i.updates(spark, d).select(
        F.col("previous_status").alias("old_status"), "new_status"))


# --- order-dependent folds and the registry ------------------------------------------------------------


@query("win_01_consecutive_duplicates", check("gated kept", """
SELECT g.customer_id, g.n AS arrived, k.n AS kept, g.n - k.n AS skipped
FROM (SELECT customer_id, count(*) AS n FROM gated GROUP BY customer_id) g
JOIN (SELECT customer_id, count(*) AS n FROM kept GROUP BY customer_id) k ON g.customer_id = k.customer_id"""))
def _(spark, d):
    guarded = views.repeat_guard(i.gated(spark, d), CUSTOMER_ARRIVAL)
    return guarded.rows.groupBy("customer_id").agg(
        F.count("*").alias("arrived"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped"))


@query("win_02_first_last_by_arrival", check("kept", f"""
SELECT customer_id, max(CASE WHEN b = 1 THEN order_id END) AS last_order_id,
       max(CASE WHEN b = 1 THEN timestamp END) AS last_order_timestamp,
       max(CASE WHEN a = 1 THEN timestamp END) AS first_order_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY a2, a1, order_id, timestamp, total, quantity) AS a,
             row_number() OVER (PARTITION BY customer_id
                                ORDER BY a2 DESC, a1 DESC, order_id DESC, timestamp DESC, total DESC, quantity DESC) AS b
      FROM gated) GROUP BY customer_id"""))
def _(spark, d):
    # an arrival order unrelated to time: late events overwrite "last"
    arrival = F.struct("a2", "a1", "order_id", "timestamp", "total", "quantity")
    picked = i.gated(spark, d).groupBy("customer_id").agg(
        F.max_by(F.struct("order_id", "timestamp"), arrival).alias("last"),
        F.min_by("timestamp", arrival).alias("first_order_timestamp"))
    return picked.select("customer_id", F.col("last.order_id").alias("last_order_id"),
                         F.col("last.timestamp").alias("last_order_timestamp"), "first_order_timestamp")


@query("reg_01_needs_update", check("csteps", """
SELECT order_id, a1, a2, timestamp, total, quantity,
       CASE WHEN n = 1 THEN 'accepted' ELSE last_value(status) OVER whole END <> status OR q1 <> quantity OR t1 <> total AS needs_update
FROM csteps WINDOW whole AS (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""))
def _(spark, d):
    stored = i.registered(spark, d).select("order_id", F.struct("status", "quantity", "total").alias("existing"))
    incoming = registry.approved(i.clean(spark, d)).withColumn("incoming", F.struct("status", "quantity", "total"))
    joined = incoming.join(stored, "order_id", "left")
    return joined.select("order_id", "a1", "a2", "timestamp", "total", "quantity",
                         registry.differs("existing", "incoming").alias("needs_update"))


@query("reg_02_version_steps", check("csteps", """
SELECT order_id, timestamp, a1, a2, rn, changed, previous_status, status, CAST(version AS BIGINT) AS version FROM csteps"""))
def _(spark, d):
    rows = i.steps(spark, d, exact_price=True).rows
    return rows.select("order_id", "timestamp", "a1", "a2", "rn", "changed", "previous_status", "status", "version")


@query("reg_03_order_updates", check("updates", "SELECT * FROM updates"))
def _(spark, d):
    return i.updates(spark, d, exact_price=False)


@query("reg_04_registered_orders", check("registered", "SELECT * FROM registered"))
def _(spark, d):
    return i.registered(spark, d, exact_price=False)


@query("reg_04_register_outcomes", check("csteps", """
SELECT count(*) FILTER (rn = 1) AS registered, count(*) FILTER (changed) AS updated,
       count(*) FILTER (rn > 1 AND NOT changed) AS skipped FROM csteps"""))
def _(spark, d):
    return registry.step_summary(i.steps(spark, d, exact_price=True))


# --- rankings -------------------------------------------------------------------------------------------


def ranked(source, order, n, columns="*"):
    return f"SELECT {columns}, row_number() OVER (ORDER BY {order}) AS rank FROM {source} ORDER BY {order} LIMIT {n}"


@query("top_01_customers_by_spent", check("customers", ranked("customers", "total_spent DESC, customer_id", 100)))
def _(spark, d):
    return monitor.top_customers(i.customers(spark, d))


@query("top_02_products_by_revenue", check("products", ranked("products", "total_revenue DESC, product_id", 10)))
def _(spark, d):
    return monitor.top_products(i.products(spark, d))


@query("top_03_customers_by_count", check("feed", ranked(
    "(SELECT customer_id, count(*) AS order_count FROM feed GROUP BY customer_id)", "order_count DESC, customer_id", 50)))
def _(spark, d):
    return store.top_by_count(i.feed(spark, d), "customer_id", 50)


@query("top_04_products_by_count", check("feed", ranked(
    "(SELECT product_id, count(*) AS order_count FROM feed GROUP BY product_id)", "order_count DESC, product_id", 50)))
def _(spark, d):
    return store.top_by_count(i.feed(spark, d), "product_id", 50)


@query("top_05_recent_orders", check(
    "latest_by_id", f"SELECT {ORDER_LIST} FROM latest_by_id ORDER BY timestamp DESC, order_id LIMIT 100"))
def _(spark, d):
    unique = views.last_arrival_per_order(i.feed(spark, d), ORDER_ARRIVAL)
    return store.recent_orders(unique, 100).select(*ORDER_COLUMNS)


@query("top_06_timeline", check("entries", "SELECT * FROM entries ORDER BY timestamp DESC, order_id LIMIT 100"))
def _(spark, d):
    return monitor.latest(i.entries(spark, d), 100)


@query("top_07_resortable_ranking", check("products", ranked(
    "products", "avg_quantity ASC, product_id", 200)))
def _(spark, d):
    return monitor.ranking(i.products(spark, d), "avg_quantity", "product_id", descending=False, n=200)


@query("top_08_recent_activity", check("merged", "SELECT * FROM merged", n=10))
def _(spark, d):
    return monitor.recent_activity(i.entries(spark, d), i.registered(spark, d))


# --- upsert, de-duplication, routing, timeline ------------------------------------------------------------


@query("ups_01_upsert", check("feed latest_by_id", f"""
SELECT {ORDER_LIST} FROM latest_by_id"""))
def _(spark, d):
    # the store after the earlier half of the feed, replaced by what the later half brings
    feed = i.feed(spark, d)
    half = 946_684_800_000
    earlier = views.last_arrival_per_order(feed.filter(F.col("timestamp") < half), ORDER_ARRIVAL)
    later = views.last_arrival_per_order(feed.filter(F.col("timestamp") >= half), ORDER_ARRIVAL)
    return store.upsert(earlier, later, ["order_id"]).select(*ORDER_COLUMNS)


@query("ded_01_first_per_order", check("feed", f"""
SELECT {ORDER_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {OA}) AS k FROM feed) WHERE k = 1"""))
def _(spark, d):
    return views.first_arrival_per_order(i.feed(spark, d), ORDER_ARRIVAL).select(*ORDER_COLUMNS)


@query("ded_02_last_per_order", check("latest_by_id", f"SELECT {ORDER_LIST} FROM latest_by_id"))
def _(spark, d):
    return views.last_arrival_per_order(i.feed(spark, d), ORDER_ARRIVAL).select(*ORDER_COLUMNS)


@query("tml_01_timeline_ring", check(
    "ring", f"SELECT {ORDER_LIST}, ring_position FROM ring"))
def _(spark, d):
    return timeline.timeline_ring(i.gated(spark, d), i.TIMELINE_ARRIVAL).select(*ORDER_COLUMNS, "ring_position")


@query("tml_02_status_overlay", check("entries cregistered", f"""
SELECT e.order_id, e.customer_id, e.product_id, e.quantity, e.unit_price, e.total, e.timestamp,
       coalesce(c.status, e.status) AS status
FROM entries e LEFT JOIN (SELECT order_id, status FROM cregistered WHERE version > 1) c ON e.order_id = c.order_id"""))
def _(spark, d):
    changes = i.registered(spark, d).filter("version > 1").select("order_id", F.col("status").alias("new_status"))
    return timeline.overlay_status(i.entries(spark, d), changes)
