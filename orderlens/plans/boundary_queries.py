"""Queries: topics, stored tables, sinks and streams. Sinks write to the shared folder and are read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from orderlens.functions import codec, rules, specs
from orderlens.functions.scalars import round_half_up
from orderlens.operators import monitor, registry, store, timeline, views
from orderlens.plans import inputs as i
from orderlens.plans.aggregate_queries import ORDER_LIST, VALIDATION_STATS
from orderlens.plans.catalog import query
from orderlens.plans.checks import GATE, RULES, ORDER_ARRIVAL as OA, arrival_desc, check, customers_sql, kept_sql, money, registered_sql, steps_sql
from orderlens.plans.row_queries import RULE_SQL, STRICT
from orderlens.schemas import ORDER_COLUMNS, TABLES
from orderlens.session import fresh_dir, stored
from orderlens.sources import topics
from orderlens.sources.feed import CUSTOMER_ARRIVAL, ORDER_ARRIVAL, table
from orderlens.sources.tables import ViewStore, read_by_time, write_by_time
from orderlens.streaming import jobs

# the feed is cut here into an earlier and a later batch
CUT = 946_684_800_000
VALUE_JSON = (
    """concat('{"order-id":"', order_id, '","customer-id":', CAST(customer_id AS VARCHAR), ',"product-id":"', product_id,"""
    """ '","quantity":', CAST(quantity AS VARCHAR), ',"unit-price":', CAST(unit_price AS VARCHAR), ',"total":',"""
    """ CAST(total AS VARCHAR), ',"timestamp":', CAST(timestamp AS VARCHAR), ',"status":"', status, '"}')"""
)


def in_memory_log(spark, d, orders=None):
    """The feed as topic records, without writing them."""
    return i.messages(i.feed(spark, d) if orders is None else orders).withColumn("topic", F.lit(topics.ORDERS))


def delivered(spark, messages, root, topic=topics.ORDERS):
    """The messages as two batches of a topic, before and after CUT."""
    for number, part in enumerate([F.unix_millis("timestamp") < CUT, F.unix_millis("timestamp") >= CUT]):
        topics.write_log(messages.filter(part), root, topic, number)


# --- topic and table sources -----------------------------------------------------------------------------------


@query("src_01_topic_source", check("placed", f"""
SELECT order_id AS key, {VALUE_JSON} AS value, 'orders' AS topic, partition, "offset", timestamp AS millis FROM placed"""))
def _(spark, d):
    log = topics.read_log(spark, i.written_log(spark, i.feed(spark, d), "src01"))
    return log.select("key", "value", "topic", "partition", "offset", F.unix_millis("timestamp").alias("millis"))


@query("src_02_multi_topic_source", check("placed", f"""
SELECT topic, partition, count(*) AS records, max("offset") AS last_offset
FROM placed, (VALUES ('orders'), ('registry')) AS t(topic) GROUP BY topic, partition"""))
def _(spark, d):
    root = i.written_log(spark, i.feed(spark, d), "src02")
    topics.write_log(topics.read_log(spark, root), root, topics.REGISTRY)
    both = topics.read_log(spark, root, [topics.ORDERS, topics.REGISTRY])
    return both.groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.max("offset").alias("last_offset"))


@query("src_03_record_envelope", check("placed", f"""
SELECT {VALUE_JSON} AS value, 'orders' AS topic, partition, "offset" FROM placed"""))
def _(spark, d):
    # bytes, as a broker delivers them
    raw = in_memory_log(spark, d).withColumns({"key": F.col("key").cast("binary"), "value": F.col("value").cast("binary")})
    return topics.as_records(raw).select("value", "topic", "partition", "offset")


def damaged_value():
    """The message of an order, damaged in ways that depend on the line's part number."""
    value = codec.to_json(ORDER_COLUMNS)
    kind = F.col("a1") % 10
    quantity = F.concat(F.lit('"quantity":'), F.col("quantity").cast("string"))
    return (
        F.when(kind == 0, F.substring(value, 1, 40))
        .when(kind == 1, F.replace(value, quantity, F.concat(F.lit('"quantity":"'), F.col("quantity"), F.lit('"'))))
        .when(kind == 2, F.replace(value, quantity, F.concat(quantity, F.lit(".7"))))
        .when(kind == 3, F.replace(value, quantity, F.lit('"quantity":3e10')))
        .when(kind == 4, F.replace(value, F.lit('"unit-price":'), F.lit('"unit-cost":')))
        .otherwise(value)
    )


def damaged(orders):
    return orders.select(damaged_value().alias("value"), "order_id", "a1", "a2")


def _decoded_sql(bad: str) -> str:
    return f"""
SELECT source_id, a1, a2, decode_error, CASE WHEN NOT decode_error THEN customer_id END AS customer_id,
       CASE WHEN NOT decode_error THEN quantity END AS quantity,
       CASE WHEN NOT decode_error AND a1 % 10 <> 4 THEN unit_price END AS unit_price,
       CASE WHEN NOT decode_error THEN total END AS total
FROM (SELECT *, order_id AS source_id, a1 % 10 IN ({bad}) AS decode_error FROM feed)"""


def decoded(spark, d, strict):
    rows = damaged(i.feed(spark, d)).withColumnRenamed("order_id", "source_id")
    out = codec.decode_orders(rows, strict_money=strict)
    ok = ~F.col("decode_error")
    return out.select("source_id", "a1", "a2", "decode_error",
                      *[F.when(ok, F.col(c)).alias(c) for c in ("customer_id", "quantity", "unit_price", "total")])


@query("src_04_decode_aggregation", check("feed", _decoded_sql("0, 1, 3, 4")))
def _(spark, d):
    return decoded(spark, d, True)


@query("src_05_decode_registry", check("feed", _decoded_sql("0, 1, 3")))
def _(spark, d):
    return decoded(spark, d, False)


@query("src_06_decode_strict", check("raw", f"""
SELECT order_id, a1, a2, total, {STRICT} AND a1 % 10 NOT IN (0, 1, 2, 3, 4) AS accepted FROM raw"""))
def _(spark, d):
    rows = i.uuid_feed(spark, d).select(
        damaged_value().alias("value"), "a1", "a2", F.col("order_id").alias("source_id"), F.col("total").alias("sent_total"))
    out = codec.decode_strict(rows)
    accepted = ~F.col("decode_error") & specs.strict_order_spec().valid()
    return out.select(F.col("source_id").alias("order_id"), "a1", "a2", F.col("sent_total").alias("total"),
                      accepted.alias("accepted"))


def envelopes(orders):
    return codec.encode_envelopes(rules.validate_orders(orders), F.col("timestamp"))


@query("src_07_decode_envelope", check("cgated", f"""
SELECT order_id, customer_id, product_id, quantity, total, timestamp, status, {RULES} AS passed, 8 AS rule_count,
       {RULES} AS usable FROM cgated"""))
def _(spark, d):
    out = codec.decode_envelopes(envelopes(views.gated(i.clean(spark, d))))
    return out.select("order_id", "customer_id", "product_id", "quantity", "total", "timestamp", "status", "passed",
                      F.size("rules").alias("rule_count"), "usable")


@query("src_08_full_scan", check("customers products cregistered", """
SELECT 'customers' AS source, count(*) AS row_count, CAST(sum(total_orders) AS BIGINT) AS checksum FROM customers
UNION ALL SELECT 'products', count(*), CAST(sum(order_count) AS BIGINT) FROM products
UNION ALL SELECT 'registered', count(*), CAST(sum(version) AS BIGINT) FROM cregistered"""))
def _(spark, d):
    kept = ViewStore(spark, fresh_dir(spark, "src08"))
    kept.write("orders_by_customer", 0, i.customers(spark, d))
    kept.write("orders_by_product", 0, i.products(spark, d))
    kept.write("registered_orders", 0, i.registered(spark, d))

    def scanned(label, name, column):
        return kept.current(name).agg(F.count("*").alias("row_count"), F.sum(column).alias("checksum")).select(
            F.lit(label).alias("source"), "row_count", "checksum")

    return scanned("customers", "orders_by_customer", "total_orders").unionByName(
        scanned("products", "orders_by_product", "order_count")).unionByName(
        scanned("registered", "registered_orders", "version"))


@query("src_09_key_lookup", check("customers products raw cregistered", f"""
SELECT 'customer' AS source, CAST(customer_id AS VARCHAR) AS key, total_orders AS value FROM customers WHERE customer_id = 42
UNION ALL SELECT 'customers', CAST(customer_id AS VARCHAR), total_orders FROM customers JOIN customer ON customer_id = c_custkey
          WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'product', product_id, order_count FROM products WHERE product_id = 'PROD-42'
UNION ALL SELECT 'order', order_id, quantity
          FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {arrival_desc(OA)}) AS k FROM raw) WHERE k = 1 AND {STRICT} AND customer_id = 42
UNION ALL SELECT 'registered', order_id, version FROM cregistered WHERE order_id IN (SELECT order_id FROM clean WHERE customer_id = 42)
UNION ALL SELECT 'processing', 'query-processor', count(*) FROM feed WHERE {GATE}
UNION ALL SELECT processor_id, 'validation', total_validated FROM ({VALIDATION_STATS})"""))
def _(spark, d):
    # the six tables are stored by bucket, and each look-up opens the buckets of its keys
    kept = ViewStore(spark, fresh_dir(spark, "src09"))

    def newest(part):
        rows = views.last_arrival_per_order(part, ORDER_ARRIVAL)
        return store.raw_rows(rows.withColumn("unit_price", round_half_up("unit_price", 2)))

    def registered(part):
        return registry.registered_orders(registry.registry_steps(part, ORDER_ARRIVAL))

    columns = [*ORDER_COLUMNS, "a1", "a2"]
    with stored(i.gated(spark, d).select(*columns), fresh_dir(spark, "src09-gated")) as rows:
        kept.write_folded("orders_by_customer", 0, rows, lambda part: views.customer_stats(part, CUSTOMER_ARRIVAL))
        kept.write_folded("orders_by_product", 0, rows, lambda part: views.product_stats(part, ORDER_ARRIVAL))
    with stored(i.uuid_feed(spark, d).select(*columns), fresh_dir(spark, "src09-raw")) as rows:
        kept.write_folded("orders", 0, rows, newest)
    with stored(registry.approved(i.clean(spark, d)).select(*columns), fresh_dir(spark, "src09-approved")) as rows:
        kept.write_folded("registered_orders", 0, rows, registered)
    kept.write("processing_stats", 0, views.processing_stats(i.feed(spark, d), "query-processor"))
    kept.write("validation_stats", 0, registry.validation_stats(i.feed(spark, d), "registry-processor"))
    building = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("int").alias("customer_id"))
    own, own_raw = (feed.filter("customer_id = 42").select("order_id") for feed in (i.clean(spark, d), i.uuid_feed(spark, d)))

    def found(source, rows, key, value):
        return rows.select(F.lit(source).alias("source"), F.col(key).cast("string").alias("key"), F.col(value).cast("bigint").alias("value"))

    answers = [
        found("customer", kept.lookup("orders_by_customer", 42), "customer_id", "total_orders"),
        found("customers", kept.lookup_many("orders_by_customer", building), "customer_id", "total_orders"),
        found("product", kept.lookup("orders_by_product", "PROD-42"), "product_id", "order_count"),
        found("order", kept.lookup_many("orders", own_raw), "order_id", "quantity"),
        found("registered", kept.lookup_many("registered_orders", own), "order_id", "version"),
        found("processing", kept.lookup("processing_stats", "query-processor"), "processor_id", "processed_count"),
    ]
    validated = kept.lookup("validation_stats", "registry-processor")
    out = validated.select(F.col("processor_id").alias("source"), F.lit("validation").alias("key"), F.col("total_validated").alias("value"))
    for answer in answers:
        out = out.unionByName(answer)
    return out


@query("src_10_order_history", check("cupdates cregistered", """
SELECT u.order_id, u.version, u.previous_status, u.new_status, r.version - u.version + 1 AS position
FROM cupdates u JOIN cregistered r ON u.order_id = r.order_id"""))
def _(spark, d):
    # every order's history, newest version first, from the stored tables, whose two batches have become one run
    kept = register_in_two_batches(spark, d, "src10", snapshot_every=2)
    newest = kept.current("registered_orders").select("order_id", F.col("version").alias("newest"))
    changes = kept.current("order_updates").join(newest, "order_id")
    return changes.select("order_id", "version", "previous_status", "new_status",
                          (F.col("newest") - F.col("version") + 1).alias("position")).orderBy("order_id", "position")


@query("src_11_raw_scan_limit", check(
    "clean", f"SELECT {ORDER_LIST}, a1, a2 FROM clean ORDER BY timestamp DESC, order_id, a1, a2 LIMIT 200"))
def _(spark, d):
    return i.clean(spark, d).orderBy(F.desc("timestamp"), "order_id", "a1", "a2").limit(200).select(
        *ORDER_COLUMNS, "a1", "a2")


@query("src_12_count_messages", check("placed", """
SELECT topic, count(*) AS messages FROM placed, (VALUES ('orders'), ('registry')) AS t(topic) GROUP BY topic"""))
def _(spark, d):
    log = topics.fan_out(in_memory_log(spark, d).drop("topic"), [topics.ORDERS, topics.REGISTRY])
    return topics.count_messages(log)


@query("src_13_peek", check("placed", """
SELECT 'first' AS seek, order_id AS key, partition, "offset" FROM (SELECT * FROM placed ORDER BY "offset", partition LIMIT 100)
UNION ALL SELECT 'last', order_id, partition, "offset"
FROM (SELECT * FROM placed ORDER BY "offset" DESC, partition DESC LIMIT 100)"""))
def _(spark, d):
    root = fresh_dir(spark, "src13")
    delivered(spark, i.messages(i.feed(spark, d)), root)

    def peeked(label, **options):
        return topics.peek_log(spark, root, topics.ORDERS, 100, **options).select(F.lit(label).alias("seek"), "key", "partition", "offset")

    return peeked("first").unionByName(peeked("last", from_beginning=False))


def committed_before(log, millis):
    """Offsets of a group that stopped reading at a time."""
    read = log.filter(F.unix_millis("timestamp") < millis)
    return read.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed_offset")).withColumn(
        "group", F.lit("query-processor"))


@query("src_14_consumer_lag", check("placed", f"""
SELECT 'query-processor' AS "group", 'orders' AS topic, partition, max("offset") + 1 AS end_offset,
       count(*) FILTER (timestamp < {CUT}) AS committed_offset, count(*) FILTER (timestamp >= {CUT}) AS lag
FROM placed GROUP BY partition"""))
def _(spark, d):
    log = in_memory_log(spark, d)
    return topics.consumer_lag(log, committed_before(log, CUT))


# --- sinks ----------------------------------------------------------------------------------------------------


@query("snk_01_orders_to_topic", check("gated", f"SELECT order_id AS key, {VALUE_JSON} AS value FROM gated"))
def _(spark, d):
    root = i.written_log(spark, i.gated(spark, d), "snk01")
    return topics.read_log(spark, root).select("key", "value")


@query("snk_02_fan_out", check("gated", """
SELECT topic, order_id AS key FROM gated, (VALUES ('orders'), ('registry')) AS t(topic)"""))
def _(spark, d):
    return topics.fan_out(codec.encode_orders(i.gated(spark, d)), [topics.ORDERS, topics.REGISTRY]).select("topic", "key")


_RULES_JSON = " || ',' || ".join(f"""'{{"rule-name":"{n}","passed":true,"message":null}}'""" for n, _, _ in RULE_SQL)


@query("snk_03_envelope_to_topic", check("approved", f"""
SELECT order_id AS key, concat('{{"order":', {VALUE_JSON}, ',"validation-result":{{"order-id":"', order_id,
       '","passed":true,"rules":[', {_RULES_JSON}, '],"message":null}},"timestamp":', CAST(timestamp AS VARCHAR), '}}') AS value
FROM approved"""))
def _(spark, d):
    return envelopes(registry.approved(i.feed(spark, d)))


def in_two_batches(spark, d, label):
    """A store and the feed's two batches, earlier and later."""
    orders = i.gated(spark, d)
    return (ViewStore(spark, fresh_dir(spark, label)),
            [orders.filter(F.col("timestamp") < CUT), orders.filter(F.col("timestamp") >= CUT)])


def millis(df, *columns):
    return df.withColumns({c: F.unix_millis(c) for c in columns})


@query("snk_04_upsert_customers", check("customers", "SELECT * FROM customers"))
def _(spark, d):
    kept, batches = in_two_batches(spark, d, "snk04")
    times = ["last_order_timestamp", "first_order_timestamp"]
    for number, batch in enumerate(batches):
        state = millis(kept.touched("orders_by_customer", number, batch), *times)
        kept.write("orders_by_customer", number, views.fold_customers(batch, CUSTOMER_ARRIVAL, state))
    return millis(kept.current("orders_by_customer"), *times)


@query("snk_05_upsert_products", check("products", "SELECT * FROM products"))
def _(spark, d):
    kept, batches = in_two_batches(spark, d, "snk05")
    for number, batch in enumerate(batches):
        state = millis(kept.touched("orders_by_product", number, batch), "last_order_timestamp")
        kept.write("orders_by_product", number, views.fold_products(batch, ORDER_ARRIVAL, state))
    return millis(kept.current("orders_by_product"), "last_order_timestamp")


@query("snk_06_timeline_table", check("entries", "SELECT * FROM entries"))
def _(spark, d):
    path = fresh_dir(spark, "snk06")
    write_by_time(i.entries(spark, d), path)
    return read_by_time(spark, path, ORDER_COLUMNS)


@query("snk_07_processing_stats", check("feed", f"""
SELECT 'query-processor' AS processor_id, count(*) FILTER ({GATE}) AS processed_count,
       count(*) FILTER (NOT {GATE}) AS error_count,
       {money(f"CASE WHEN {GATE} AND status = 'accepted' THEN total END")} AS total_revenue_accepted,
       max(timestamp) FILTER ({GATE}) AS last_processed_timestamp FROM feed"""))
def _(spark, d):
    kept = ViewStore(spark, fresh_dir(spark, "snk07"))
    sums = ["processed_count", "error_count", "total_revenue_accepted"]
    feed = i.feed(spark, d)
    for number, batch in enumerate([feed.filter(F.col("timestamp") < CUT), feed.filter(F.col("timestamp") >= CUT)]):
        state = millis(kept.before("processing_stats", number), "last_processed_timestamp")
        fresh = views.processing_stats(batch, "query-processor")
        kept.write("processing_stats", number,
                   views.fold_counters(fresh, state, "processor_id", sums, "last_processed_timestamp"))
    return millis(kept.current("processing_stats"), "last_processed_timestamp")


@query("snk_08_save_all_views", check("customers products entries", """
SELECT 'orders_by_customer' AS view, count(*) AS row_count, sum(total_orders) AS checksum FROM customers
UNION ALL SELECT 'orders_by_product', count(*), sum(order_count) FROM products
UNION ALL SELECT 'orders_timeline', 100, 100
UNION ALL SELECT 'processing_stats', 1, (SELECT sum(order_count) FROM products)"""))
def _(spark, d):
    kept = ViewStore(spark, fresh_dir(spark, "snk08"))
    valid = i.gated(spark, d)
    kept.write("orders_by_customer", 0, i.customers(spark, d))
    kept.write("orders_by_product", 0, i.products(spark, d))
    kept.write("orders_timeline", 0, timeline.timeline_ring(valid, i.TIMELINE_ARRIVAL))
    kept.write("processing_stats", 0, views.processing_stats(i.feed(spark, d), "query-processor"))

    def summed(name, amount):
        return kept.current(name).agg(F.count("*").alias("row_count"), F.sum(amount).alias("checksum")).select(
            F.lit(name).alias("view"), "row_count", "checksum")

    out = summed("orders_by_customer", F.col("total_orders"))
    for name, amount in (("orders_by_product", F.col("order_count")), ("orders_timeline", F.lit(1)),
                         ("processing_stats", F.col("processed_count"))):
        out = out.unionByName(summed(name, amount))
    return out


def register_in_two_batches(spark, d, label, snapshot_every=20):
    kept = ViewStore(spark, fresh_dir(spark, label), snapshot_every)
    orders = registry.approved(i.clean(spark, d))
    for number, batch in enumerate([orders.filter(F.col("timestamp") < CUT), orders.filter(F.col("timestamp") >= CUT)]):
        def steps(part):
            state = millis(kept.touched("registered_orders", number, part), "registered_at", "updated_at")
            return registry.registry_steps(part, ORDER_ARRIVAL, state)

        with stored(batch.select(*ORDER_COLUMNS, "a1", "a2"), fresh_dir(spark, f"{label}-batch")) as rows:
            kept.write_folded("registered_orders", number, rows, lambda part: registry.registered_orders(steps(part)))
            kept.write_folded("order_updates", number, rows, lambda part: registry.order_updates(steps(part)))
    return kept


@query("snk_09_upsert_registered", check("cregistered", "SELECT * FROM cregistered"))
def _(spark, d):
    kept = register_in_two_batches(spark, d, "snk09")
    return millis(kept.current("registered_orders"), "registered_at", "updated_at")


@query("snk_10_append_history", check("cupdates", "SELECT * FROM cupdates"))
def _(spark, d):
    kept = register_in_two_batches(spark, d, "snk10")
    return millis(kept.current("order_updates"), "updated_at")


@query("snk_11_validation_stats", check("feed", f"""
SELECT processor_id, total_validated, total_approved, total_rejected, timestamp FROM ({VALIDATION_STATS})"""))
def _(spark, d):
    kept = ViewStore(spark, fresh_dir(spark, "snk11"))
    feed, sums = i.feed(spark, d), ["total_validated", "total_approved", "total_rejected"]
    for number, batch in enumerate([feed.filter(F.col("timestamp") < CUT), feed.filter(F.col("timestamp") >= CUT)]):
        state = millis(kept.before("validation_stats", number), "timestamp")
        fresh = registry.validation_stats(batch, "registry-processor")
        kept.write("validation_stats", number, views.fold_counters(fresh, state, "processor_id", sums, "timestamp"))
    return millis(kept.current("validation_stats"), "timestamp")


@query("snk_12_raw_orders", check("raw", f"""
SELECT order_id, customer_id, product_id, quantity, CAST(floor(unit_price * 100 + 0.5) / 100 AS DECIMAL(18,2)) AS unit_price,
       CAST(total AS DECIMAL(18,2)) AS total, timestamp, status FROM raw WHERE {STRICT}"""))
def _(spark, d):
    path = fresh_dir(spark, "snk12")
    priced = i.uuid_feed(spark, d).withColumn("unit_price", round_half_up("unit_price", 2))
    write_by_time(store.raw_rows(priced), path)
    written = read_by_time(spark, path, TABLES["orders"].schema.names)
    return written.withColumn("timestamp", F.unix_millis("timestamp"))


@query("snk_13_table_definitions", check("customers", """
SELECT * FROM customers"""))
def _(spark, d):
    # all tables are created empty first; then one is filled through its definition
    kept = ViewStore(spark, fresh_dir(spark, "snk13"))
    kept.bootstrap()
    kept.write("orders_by_customer", 1, i.customers(spark, d))
    return millis(kept.current("orders_by_customer"), "last_order_timestamp", "first_order_timestamp")


@query("snk_14_views_to_json", check("customers products entries cregistered", f"""
SELECT concat('{{"customer_id":', CAST(customer_id AS VARCHAR), ',"total_orders":', CAST(total_orders AS VARCHAR),
       ',"last_order_id":"', last_order_id, '","last_order_timestamp":', CAST(last_order_timestamp AS VARCHAR),
       ',"first_order_timestamp":', CAST(first_order_timestamp AS VARCHAR), '}}') AS json FROM customers
UNION ALL SELECT concat('{{"product_id":"', product_id, '","total_quantity":', CAST(total_quantity AS VARCHAR),
       ',"order_count":', CAST(order_count AS VARCHAR), ',"last_order_timestamp":', CAST(last_order_timestamp AS VARCHAR), '}}') FROM products
UNION ALL SELECT {VALUE_JSON} FROM entries
UNION ALL SELECT concat('{{"order-id":"', order_id, '","status":"', status, '","version":', CAST(version AS VARCHAR),
       ',"updated-at":', coalesce(CAST(updated_at AS VARCHAR), 'null'), '}}') FROM cregistered"""))
def _(spark, d):
    customers = i.customers(spark, d).select(codec.to_json(
        ["customer_id", "total_orders", "last_order_id", "last_order_timestamp", "first_order_timestamp"],
        kebab=False).alias("json"))
    products = i.products(spark, d).select(codec.to_json(
        ["product_id", "total_quantity", "order_count", "last_order_timestamp"], kebab=False).alias("json"))
    entries = i.entries(spark, d).select(codec.to_json(ORDER_COLUMNS).alias("json"))
    registered = i.registered(spark, d).select(
        codec.to_json(["order_id", "status", "version", "updated_at"]).alias("json"))
    return customers.unionByName(products).unionByName(entries).unionByName(registered)


@query("snk_15_orders_by_timestamp", check("clean", f"SELECT {ORDER_LIST} FROM clean WHERE timestamp IS NOT NULL AND order_id IS NOT NULL"))
def _(spark, d):
    path = fresh_dir(spark, "snk15")
    write_by_time(store.by_timestamp(i.clean(spark, d)).select(*ORDER_COLUMNS), path)
    return read_by_time(spark, path, ORDER_COLUMNS)


# --- routing ----------------------------------------------------------------------------------------------------


@query("rou_01_route_by_topic", check("cplaced", f"""
SELECT 'consumer' AS job, count(*) AS total, count(*) FILTER (partition <> 2) AS success, count(*) FILTER (partition = 2) AS errors,
       'Unknown topic' AS reason, count(*) FILTER (partition = 2) AS rejected FROM cplaced
UNION ALL SELECT 'validate', count(*), count(*) FILTER ({GATE}), count(*) FILTER (NOT {GATE}), NULL, NULL FROM cplaced WHERE partition = 0
UNION ALL SELECT 'register', count(*), count(*) FILTER ({GATE} AND {RULES}), count(*) FILTER (NOT ({GATE} AND {RULES})),
       'no approved order', count(*) FILTER (NOT ({GATE} AND {RULES})) FROM cplaced WHERE partition = 1"""))
def _(spark, d):
    # one consumer over three topics: orders, registry messages (some of which hold no approved order), and one nobody knows
    root = fresh_dir(spark, "rou01")

    def judged(placed):
        orders = codec.decode_orders(placed).withColumn("approved", rules.outcome() == rules.APPROVED)
        return rules.validate_orders(orders).select(
            F.col("order_id").alias("key"),
            F.when(F.col("approved"), codec.envelope_json(F.unix_millis("arrival_time"))).otherwise(codec.to_json(ORDER_COLUMNS)).alias("value"),
            "partition", "offset", F.col("arrival_time").alias("timestamp"))

    with i.deliveries(spark, i.clean(spark, d), "rou01") as placed:
        topics.write_log([part.filter("partition = 0") for part in placed.parts()], root, topics.ORDERS)
        topics.write_log([judged(part.filter("partition = 1")) for part in placed.parts()], root, topics.REGISTRY)
        topics.write_log([part.filter("partition = 2") for part in placed.parts()], root, "other")
    kept = jobs.open_store(spark, fresh_dir(spark, "rou01-store"))
    jobs.consumer_job(topics.stream_log(spark, root, [topics.ORDERS, topics.REGISTRY, "other"]), kept, fresh_dir(spark, "rou01-out"),
                      fresh_dir(spark, "rou01-cp"), once=True).awaitTermination()
    left_out = jobs.rejects(kept).filter("reason IN ('Unknown topic', 'no approved order')").groupBy("reason").agg(F.count("*").alias("rejected"))
    left_out = left_out.withColumn("job", F.when(F.col("reason") == "Unknown topic", "consumer").otherwise("register"))
    return jobs.outcomes(kept).select("job", "total", "success", "errors").join(left_out, "job", "left")


@query("rou_02_split_outcomes", check("feed", f"""
SELECT order_id, a1, a2, total, CASE WHEN NOT {GATE} THEN 'skipped' WHEN {RULES} THEN 'forwarded' ELSE 'held back' END AS branch
FROM feed"""))
def _(spark, d):
    tagged = i.feed(spark, d).select("order_id", "a1", "a2", "total", rules.outcome().alias("outcome"))
    names = {rules.APPROVED: "forwarded", rules.REJECTED: "held back", rules.MALFORMED: "skipped"}
    branches = [tagged.filter(F.col("outcome") == o).withColumn("branch", F.lit(b)) for o, b in names.items()]
    return branches[0].unionByName(branches[1]).unionByName(branches[2]).drop("outcome")


# --- streams --------------------------------------------------------------------------------------------------

TOPIC_ARRIVAL = 'timestamp, partition, "offset"'


def _stream_customers(source):
    return check(source, f"""SELECT * FROM ({customers_sql(f'({kept_sql(f"(SELECT * FROM {source} WHERE {GATE})", TOPIC_ARRIVAL)})', TOPIC_ARRIVAL)})""")


def run_views(spark, d, label):
    """Orders-to-views stream over the whole feed, run to its end."""
    root = i.written_log(spark, i.feed(spark, d), label)
    kept = jobs.open_store(spark, fresh_dir(spark, label + "-views"))
    jobs.views_job(topics.stream_log(spark, root), kept, fresh_dir(spark, label + "-cp"), once=True).awaitTermination()
    return kept


@query("str_01_orders_to_views", _stream_customers("placed"))
def _(spark, d):
    kept = run_views(spark, d, "str01")
    return millis(kept.current("orders_by_customer"), "last_order_timestamp", "first_order_timestamp")


def run_registry(spark, d, label):
    """Both hops: orders to the registry topic, and that topic to registered orders."""
    root = i.written_log(spark, i.clean(spark, d), label)
    kept = jobs.open_store(spark, fresh_dir(spark, label + "-registry"))
    jobs.validate_job(topics.stream_log(spark, root), kept, root, fresh_dir(spark, label + "-cp1"),
                      once=True).awaitTermination()
    jobs.register_job(topics.stream_log(spark, root, [topics.REGISTRY]), kept, fresh_dir(spark, label + "-cp2"),
                      once=True).awaitTermination()
    return kept


def _stream_steps(body):
    source = f"(SELECT * FROM cplaced WHERE {GATE} AND {RULES})"
    return check("cplaced", f"SELECT {body} FROM ({registered_sql(f'({steps_sql(source, TOPIC_ARRIVAL)})')})")


@query("str_02_two_hops", _stream_steps("order_id, quantity, total, status, registered_at, updated_at, version"))
def _(spark, d):
    kept = run_registry(spark, d, "str02")
    return millis(kept.current("registered_orders"), "registered_at", "updated_at").select(
        "order_id", "quantity", "total", "status", "registered_at", "updated_at", "version")


def two_deliveries(spark, d, label, run):
    """The feed as two deliveries of a topic, each followed by a run of the stream from its checkpoint."""
    root, checkpoint = fresh_dir(spark, label + "-log"), fresh_dir(spark, label + "-cp")
    placed = i.messages(i.feed(spark, d))
    for number, part in enumerate([F.unix_millis("timestamp") < CUT, F.unix_millis("timestamp") >= CUT]):
        topics.write_log(placed.filter(part), root, topics.ORDERS, number)
        run(topics.stream_log(spark, root), checkpoint)


@query("str_03_stateful_customers", _stream_customers("placed"))
def _(spark, d):
    kept = jobs.open_store(spark, fresh_dir(spark, "str03-views"))
    two_deliveries(spark, d, "str03", lambda log, cp: jobs.views_job(log, kept, cp, once=True).awaitTermination())
    return millis(kept.current("orders_by_customer"), "last_order_timestamp", "first_order_timestamp")


@query("str_04_stateful_products", check("products", "SELECT * FROM products"))
def _(spark, d):
    root = i.written_log(spark, i.feed(spark, d), "str04")
    out = fresh_dir(spark, "str04-out")
    changes = jobs.product_stream(topics.stream_log(spark, root))
    jobs.append_updates(changes, out, fresh_dir(spark, "str04-cp"), once=True).awaitTermination()
    return jobs.latest_updates(spark, out, changes.schema, ["product_id"])


@query("str_05_stateful_registry", check("placed", f"""
SELECT order_id, CAST(version AS BIGINT) AS version, previous_status, status AS new_status FROM (
  SELECT *, 1 + sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY rn) AS version FROM (
    SELECT *, rn > 1 AND (previous_status <> status OR quantity <> q1 OR total <> t1) AS changed FROM (
      SELECT *, row_number() OVER k AS rn, first_value(quantity) OVER k AS q1, first_value(total) OVER k AS t1,
             CASE row_number() OVER k WHEN 1 THEN NULL WHEN 2 THEN 'accepted' ELSE lag(status) OVER k END AS previous_status
      FROM placed WHERE {GATE} AND {RULES} WINDOW k AS (PARTITION BY order_id ORDER BY {TOPIC_ARRIVAL}))))
WHERE changed"""))
def _(spark, d):
    # the same stream over two deliveries: the second continues from the state the first left
    kept = jobs.open_store(spark, fresh_dir(spark, "str05"))
    root = fresh_dir(spark, "str05-log")
    checkpoint = fresh_dir(spark, "str05-cp")
    placed = i.messages(i.feed(spark, d))
    for number, part in enumerate([F.unix_millis("timestamp") < CUT, F.unix_millis("timestamp") >= CUT]):
        orders = codec.decode_orders(placed.filter(part))
        passed = rules.validate_orders(registry.approved(orders))
        sent = passed.select(
            F.col("order_id").alias("key"), codec.envelope_json(F.unix_millis("arrival_time")).alias("value"),
            "partition", "offset", F.col("arrival_time").alias("timestamp"))
        topics.write_log(sent, root, topics.REGISTRY, number)
        jobs.register_job(topics.stream_log(spark, root, [topics.REGISTRY]), kept, checkpoint, once=True).awaitTermination()
    return kept.current("order_updates").select("order_id", "version", "previous_status", "new_status")


@query("str_06_committed_offsets", check("placed", """
SELECT 'orders' AS topic, partition, max("offset") + 1 AS end_offset, max("offset") + 1 AS committed_offset, 0 AS lag
FROM placed GROUP BY partition"""))
def _(spark, d):
    # what the stream has persisted when its trigger ends equals what the topic holds
    root = i.written_log(spark, i.feed(spark, d), "str06")
    out = fresh_dir(spark, "str06-out")
    ends = topics.end_offsets(topics.stream_log(spark, root))
    jobs.append_updates(ends, out, fresh_dir(spark, "str06-cp"), once=True).awaitTermination()
    done = jobs.latest_updates(spark, out, ends.schema, ["topic", "partition"]).select(
        F.lit("g").alias("group"), "topic", "partition", F.col("end_offset").alias("committed_offset"))
    return topics.consumer_lag(topics.read_log(spark, root), done).drop("group")


@query("str_07_bad_records", check("placed", f"""
SELECT partition, "offset", reason FROM (
  SELECT partition, "offset", CASE WHEN a1 % 10 IN (0, 1, 3, 4) THEN 'undecodable'
         WHEN NOT {GATE} THEN 'customer_id: must be positive' END AS reason FROM placed) WHERE reason IS NOT NULL"""))
def _(spark, d):
    feed = i.feed(spark, d)
    root = fresh_dir(spark, "str07")
    placed = topics.assign_offsets(
        feed.withColumns({"key": F.col("order_id"), "message": damaged_value()}), i.TIMELINE_ARRIVAL)
    sent = placed.select("key", F.col("message").alias("value"), "partition", "offset",
                         F.timestamp_millis("timestamp").alias("timestamp"))
    topics.write_log(sent, root, topics.ORDERS)
    kept = jobs.open_store(spark, fresh_dir(spark, "str07-views"))
    jobs.views_job(topics.stream_log(spark, root), kept, fresh_dir(spark, "str07-cp"), once=True).awaitTermination()
    return jobs.rejects(kept).select("partition", "offset", "reason")


LATE_ARRIVAL = 'delivery, timestamp, partition, "offset"'
_LATE = f"(SELECT *, CASE WHEN timestamp >= {CUT} THEN 0 ELSE 1 END AS delivery FROM placed WHERE {GATE})"


@query("str_08_late_data", check("placed", f"""
SELECT 'unbounded' AS mode, customer_id, last_order_id, last_order_timestamp, total_orders AS taken, 0 AS dropped
FROM ({customers_sql(f'({kept_sql(_LATE, LATE_ARRIVAL)})', LATE_ARRIVAL)})
UNION ALL SELECT 'bounded', NULL, NULL, NULL, count(DISTINCT order_id) FILTER (NOT late), count(*) FILTER (late)
FROM (SELECT order_id, delivery = 1 AND timestamp <= (SELECT max(timestamp) FROM {_LATE} WHERE delivery = 0) - {30 * 86_400_000} AS late FROM {_LATE})"""))
def _(spark, d):
    # the newer half of the events is delivered first. The views take the older half too, and "last" follows arrival; the
    # de-duplicating stream, with its watermark of 30 days, leaves late rows out and counts them
    root, kept, out, done = (fresh_dir(spark, f"str08-{x}") for x in ("log", "views", "out", "cp"))
    kept, late = jobs.open_store(spark, kept), 0
    for number, times in enumerate([{"since": CUT}, {"before": CUT}]):
        single = f"{root}/{number}"  # a log for each delivery, as offsets go back
        with i.deliveries(spark, i.feed(spark, d), "str08", [CUT]) as placed:
            topics.write_log(placed.parts(**times), single, topics.ORDERS)
            topics.write_log(placed.parts(**times), root, "both", number)
        jobs.run_views_batch(kept, topics.read_log(spark, single).withColumn("topic", F.lit(f"orders-{number}")), number)
        query = jobs.append_rows(jobs.first_per_order_stream(topics.stream_log(spark, root, ["both"]), "30 days", []).select("order_id"), out, done, once=True)
        query.awaitTermination()
        late += jobs.dropped_as_late(query)
    unbounded = millis(kept.current("orders_by_customer"), "last_order_timestamp").select(
        F.lit("unbounded").alias("mode"), "customer_id", "last_order_id", "last_order_timestamp", F.col("total_orders").alias("taken"),
        F.lit(0).cast("bigint").alias("dropped"))
    taken = spark.read.schema("order_id string").parquet(out).agg(F.count("*").alias("taken"))
    return unbounded.unionByName(taken.select(F.lit("bounded").alias("mode"), "taken", F.lit(late).cast("bigint").alias("dropped")), allowMissingColumns=True)


@query("str_09_rebuild_views", check("products", "SELECT * FROM products"))
def _(spark, d):
    # three deliveries; the change log up to the last snapshot is lost, and the views are read from snapshot and later changes
    root, checkpoint, views_root = (fresh_dir(spark, f"str09-{x}") for x in ("log", "cp", "views"))
    early, lost = CUT - 40_000_000_000, 0
    for number, times in enumerate([{"before": early}, {"since": early, "before": CUT}, {"since": CUT}]):
        kept = jobs.open_store(spark, views_root, snapshot_every=1)  # as after a restart: nothing is known but the folders
        with i.deliveries(spark, i.feed(spark, d), "str09", [early, CUT]) as placed:
            topics.write_log(placed.parts(**times), root, topics.ORDERS, number)
        jobs.views_job(topics.stream_log(spark, root), kept, checkpoint, once=True).awaitTermination()
        lost += kept.forget_before_snapshot("orders_by_product")
    assert lost == 2, "the changes of two batches are covered by a snapshot"
    return millis(jobs.open_store(spark, views_root).current("orders_by_product"), "last_order_timestamp")


@query("str_10_redelivery", check("placed", f"""
SELECT count(*) FILTER ({GATE}) AS processed_count, count(*) FILTER (NOT {GATE}) AS error_count,
       CAST(sum(quantity) FILTER ({GATE}) AS BIGINT) AS quantity FROM placed"""))
def _(spark, d):
    # every message comes again, at a new offset, in a second delivery through the stream
    root, checkpoint = fresh_dir(spark, "str10-log"), fresh_dir(spark, "str10-cp")
    kept = jobs.open_store(spark, fresh_dir(spark, "str10-views"))
    for number in range(2):
        with i.deliveries(spark, i.feed(spark, d), "str10") as placed:
            parts = placed.parts()
            topics.write_log(parts if number == 0 else [topics.shifted(p, placed.ends) for p in parts], root, topics.ORDERS, number)
        jobs.views_job(topics.stream_log(spark, root), kept, checkpoint, once=True, once_per_message=True).awaitTermination()
    quantity = kept.current("orders_by_product").agg(F.sum("total_quantity").alias("quantity"))
    return views.merge_single_rows([kept.current("processing_stats").select("processed_count", "error_count"), quantity])


@query("str_10_reset_on_existing_store", check("placed", f"""
SELECT count(*) FILTER ({GATE}) AS processed_count, count(*) FILTER (NOT {GATE}) AS error_count FROM placed"""))
def _(spark, d):
    # a new checkpoint reads the topic from its start again, on a store that has consumed it: nothing counts twice
    root, kept = i.written_log(spark, i.feed(spark, d), "str10r"), jobs.open_store(spark, fresh_dir(spark, "str10r-views"))
    for _ in range(2):
        jobs.views_job(topics.stream_log(spark, root), kept, fresh_dir(spark, "str10r-cp"), once=True).awaitTermination()
    return kept.current("processing_stats").select("processed_count", "error_count")


@query("str_11_replay_from_offset", check("placed", f"""
SELECT 'earliest' AS start, partition, count(*) AS records FROM placed GROUP BY partition
UNION ALL SELECT 'offset', partition, count(*) FROM placed WHERE partition <> 1 OR "offset" >= 1000 GROUP BY partition
UNION ALL SELECT 'time', partition, count(*) FROM placed WHERE timestamp >= {CUT} GROUP BY partition
UNION ALL SELECT 'latest', partition, count(*) FROM placed WHERE timestamp >= {CUT} GROUP BY partition"""))
def _(spark, d):
    # streams started with new checkpoints; "latest" is asked for after the first delivery and gets the second
    root = fresh_dir(spark, "str11")
    with i.deliveries(spark, i.feed(spark, d), "str11", [CUT]) as placed:
        topics.write_log(placed.parts(before=CUT), root, topics.ORDERS, 0)
        streams = {"latest": topics.stream_from(spark, root, topics.ORDERS, latest=True)}
        topics.write_log(placed.parts(since=CUT), root, topics.ORDERS, 1)
    streams["earliest"] = topics.stream_from(spark, root, topics.ORDERS)
    streams["offset"] = topics.stream_from(spark, root, topics.ORDERS, offsets={1: 1000})
    streams["time"] = topics.stream_from(spark, root, topics.ORDERS, since=datetime.fromtimestamp(CUT / 1000))
    counted = None
    for label, messages in streams.items():
        out = fresh_dir(spark, f"str11-{label}")
        jobs.append_rows(messages.select("partition", "offset"), out, fresh_dir(spark, f"str11-{label}-cp"), once=True).awaitTermination()
        part = spark.read.schema("partition int, offset bigint").parquet(out).groupBy("partition").agg(F.count("*").alias("records"))
        part = part.withColumn("start", F.lit(label))
        counted = part if counted is None else counted.unionByName(part)
    return counted


@query("agg_16_job_outcomes", check("cplaced", f"""
SELECT job, total, success, total - success AS errors FROM (
  SELECT unnest(['views', 'validate']) AS job, count(*) AS total, count(*) FILTER ({GATE}) AS success FROM cplaced
  UNION ALL SELECT 'register', count(*), count(*) FROM cplaced WHERE {GATE} AND {RULES})"""))
def _(spark, d):
    # each job writes one row per batch: what it got, what it could use and what it could not
    root, kept = i.written_log(spark, i.clean(spark, d), "agg16"), jobs.open_store(spark, fresh_dir(spark, "agg16-store"))
    for run in (lambda cp: jobs.views_job(topics.stream_log(spark, root), kept, cp, once=True),
                lambda cp: jobs.validate_job(topics.stream_log(spark, root), kept, root, cp, once=True),
                lambda cp: jobs.register_job(topics.stream_log(spark, root, [topics.REGISTRY]), kept, cp, once=True)):
        run(fresh_dir(spark, "agg16-cp")).awaitTermination()
    return jobs.outcomes(kept).groupBy("job").agg(*[F.sum(c).alias(c) for c in ("total", "success", "errors")])
