"""JSON boundary, topics, stored tables and the streaming jobs."""

import pytest
from pyspark.sql import functions as F

from orderlens.functions import codec, rules
from orderlens.functions.specs import order_spec
from orderlens.operators import registry, timeline, views
from orderlens.schemas import ORDER_COLUMNS, TABLES, TableSpec
from orderlens.session import fresh_dir
from orderlens.sources import topics
from orderlens.sources.feed import order_feed
from orderlens.sources.tables import ViewStore, conform, read_by_time, write_by_time
from orderlens.plans import inputs
from orderlens.streaming import jobs
from tests.conftest import SF_DIR

GOOD = ('{"order-id":"O1","customer-id":1,"product-id":"P1","quantity":1,"unit-price":10.0,"total":10.0,'
        '"timestamp":1000,"status":"pending"}')


def swapped(old, new):
    assert old in GOOD
    return GOOD.replace(old, new)


CASES = {
    "good": (GOOD, False, False),
    "bad json": ("bad-json", True, True),
    "cut off": (GOOD[:40], True, True),
    "empty": ("", True, True),
    "null": (None, True, True),
    "a list": ("[1]", True, True),
    "fraction": (swapped('"quantity":1', '"quantity":5.7'), False, False),
    "quoted number": (swapped('"quantity":1', '"quantity":"5"'), True, True),
    "too large": (swapped('"quantity":1', '"quantity":3e10'), True, True),
    "no price": (swapped('"unit-price":10.0,', ""), True, False),
    "null customer": (swapped('"customer-id":1', '"customer-id":null'), True, True),
    "extra key": (swapped('{', '{"extra":[1,{"a":2}],'), False, False),
}


@pytest.mark.parametrize("name", CASES)
def test_decode(spark, name):
    text, strict_error, lenient_error = CASES[name]
    df = spark.createDataFrame([(text,)], "value string")
    strict, lenient = codec.decode_orders(df).first(), codec.decode_orders(df, strict_money=False).first()
    assert (strict["decode_error"], lenient["decode_error"]) == (strict_error, lenient_error)
    if name == "fraction":
        assert strict["quantity"] == 5
    if name == "no price":
        # decodes, and is then refused by the gate
        assert lenient["unit_price"] is None
        assert not codec.decode_orders(df, strict_money=False).select(order_spec().valid()).first()[0]


def test_decode_strict_wants_whole_numbers(spark):
    texts = [GOOD, CASES["fraction"][0], CASES["quoted number"][0], CASES["too large"][0], "bad-json", None]
    df = spark.createDataFrame([(t, n) for n, t in enumerate(texts)], "value string, n int")
    got = codec.decode_strict(df).orderBy("n").collect()
    assert [r["decode_error"] for r in got] == [False, True, True, True, True, True]


def test_order_round_trip(spark):
    orders = order_feed(spark, SF_DIR).select(*ORDER_COLUMNS)
    back = codec.decode_orders(codec.encode_orders(orders)).drop("decode_error").select(*ORDER_COLUMNS)
    assert orders.exceptAll(back).count() == 0 and back.count() == orders.count()


def test_envelope_round_trip_and_skips(spark, orders):
    sent = rules.validate_orders(orders(("ORD-FLOW-1", 100, "PROD-X", 2, 50.0, 100.0, 1234567890, "pending"),
                                        ("ORD-BAD-1", 100, "PROD-X", 2000, 50.0, 100000.0, 1234567890, "pending")))
    messages = codec.encode_envelopes(sent, F.lit(7)).unionByName(spark.createDataFrame(
        [("a", GOOD), ("b", '{"validation-result":{"passed":true}}'), ("c", "nonsense")], "key string, value string"))
    got = codec.decode_envelopes(messages).collect()
    assert [r["usable"] for r in got] == [True, False, False, False, False]
    assert [r["rule_name"] for r in got[0]["rules"]][:2] == ["minimum-quantity", "maximum-quantity"]
    assert got[4]["decode_error"] and not got[2]["decode_error"]


def test_batch_outcome(spark):
    df = spark.createDataFrame([(GOOD,), ("bad-json",)], "value string")
    row = views.processing_stats(codec.decode_orders(df), "p").first()
    assert (row["processed_count"], row["error_count"]) == (1, 1)


def test_view_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "customer_id int, last_order_id string")
    assert df.select(codec.to_json(df.columns, kebab=False)).first()[0] == '{"customer_id":1,"last_order_id":null}'
    assert df.select(codec.to_json(df.columns)).first()[0] == '{"customer-id":1,"last-order-id":null}'


# --- topics ------------------------------------------------------------------------------------------------------


def test_offsets_are_dense_also_when_partitions_are_cut(spark):
    messages = inputs.feed(spark, SF_DIR).withColumn("key", F.col("order_id"))
    order = inputs.TIMELINE_ARRIVAL
    plain = topics.assign_offsets(messages, order)
    cut = topics.assign_offsets(messages, order, segments=50)
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0
    for row in cut.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                            F.count_distinct("offset").alias("d")).collect():
        assert (row["lo"], row["hi"], row["d"]) == (0, row["n"] - 1, row["n"])


def test_topic_operations(spark):
    rows = [("k", "v", "orders", p, o, None) for p in (0, 1) for o in range(5)] + [("k", "v", "other", 0, 0, None)]
    log = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    assert {r["topic"]: r["messages"] for r in topics.count_messages(log).collect()} == {"orders": 10, "other": 1}
    assert [(r["partition"], r["offset"]) for r in topics.peek(log, "orders", 3).collect()] == [(0, 0), (1, 0), (0, 1)]
    assert [r["offset"] for r in topics.peek(log, "orders", 2, from_beginning=False).collect()] == [4, 4]
    committed = spark.createDataFrame([("g", "orders", 0, 3)], "group string, topic string, partition int, committed_offset long")
    lag = {r["partition"]: r["lag"] for r in topics.consumer_lag(log, committed).collect()}
    assert lag == {0: 2, 1: 5}
    routed = topics.route(log)
    assert routed["validate"].count() == 10 and routed["unknown"].first()["error"] == "Unknown topic"
    assert topics.replay_from(log.filter("topic = 'orders'"), {0: 4}).count() == 6


def test_kafka_options():
    options = topics.kafka_options("host:9092", ["orders", "registry"])
    assert options["subscribe"] == "orders,registry" and options["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in options
    assert topics.kafka_options("h", ["orders"], max_records=500)["maxOffsetsPerTrigger"] == "500"
    since = topics.kafka_options("h", ["orders"], since_millis=7)
    assert since["startingTimestamp"] == "7" and "startingOffsets" not in since


# --- tables --------------------------------------------------------------------------------------------------------


def test_store_upserts_replays_and_snapshots(spark):
    spec = TableSpec("t", TABLES["statistics"].schema, ("metric",))
    kept = ViewStore(spark, fresh_dir(spark, "store"), snapshot_every=2, tables={"t": spec})
    assert kept.current("t").count() == 0

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), spec.schema)

    def state(df):
        return {r["metric"]: r["value"] for r in df.collect()}

    for batch in range(5):
        kept.write("t", batch, rows(("a", batch), (f"k{batch}", 1)))
        kept.write("t", batch, rows(("a", batch * 10), (f"k{batch}", 2)))      # the batch is delivered again
    assert state(kept.current("t")) == {"a": 40, **{f"k{b}": 2 for b in range(5)}}
    assert state(kept.before("t", 3)) == {"a": 20, "k0": 2, "k1": 2, "k2": 2}
    assert kept.changes("t").count() == 10 and kept.last_batch("t") == 4


def test_all_tables_can_be_created(spark):
    kept = jobs.open_store(spark, fresh_dir(spark, "tables"))
    kept.bootstrap()
    assert all(kept.current(name).count() == 0 for name in kept.tables)
    assert set(TABLES) <= set(kept.tables) and len(TABLES) == 9


def test_write_by_time(spark):
    path = fresh_dir(spark, "bytime")
    orders = order_feed(spark, SF_DIR).select(*ORDER_COLUMNS)
    write_by_time(orders, path)
    assert read_by_time(spark, path, ORDER_COLUMNS).exceptAll(orders).count() == 0


# --- streams -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def slices(spark):
    """The feed as four successive deliveries of the orders topic."""
    placed = inputs.messages(inputs.clean(spark, SF_DIR)).persist()
    cuts = placed.approxQuantile("offset", [0.25, 0.5, 0.75], 0.0)
    edges = [-1, *cuts, float("inf")]
    yield [placed.filter((F.col("offset") > lo) & (F.col("offset") <= hi)) for lo, hi in zip(edges, edges[1:])]
    placed.unpersist()


def same(left, right):
    columns = left.columns
    right = right.select(*columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_views_stream_equals_batch(spark, slices):
    root, checkpoint = fresh_dir(spark, "log"), fresh_dir(spark, "cp")
    kept = jobs.open_store(spark, fresh_dir(spark, "views"), snapshot_every=2)
    rows = None
    for number, part in enumerate(slices):
        topics.write_log(part, root, topics.ORDERS, number)
        jobs.views_job(topics.stream_log(spark, root), kept, checkpoint, once=True, ring_size=20).awaitTermination()
        rows = part if rows is None else rows.unionByName(part)
    # arrival follows the deliveries, and within one the topic's order
    arrived = None
    for number, part in enumerate(slices):
        piece = codec.decode_orders(part).withColumn("delivery", F.lit(number))
        arrived = piece if arrived is None else arrived.unionByName(piece)
    arrival = ["delivery", *views.TOPIC_ARRIVAL]
    valid = views.gated(arrived)
    assert kept.last_batch("orders_by_customer") == 3

    stored = kept.current("orders_by_customer")
    for c in ("last_order_timestamp", "first_order_timestamp"):
        stored = stored.withColumn(c, F.unix_millis(c))
    assert same(views.customer_stats(valid, arrival), stored)
    products = kept.current("orders_by_product").withColumn("last_order_timestamp", F.unix_millis("last_order_timestamp"))
    assert same(views.product_stats(valid, arrival), products)
    ring = timeline.timeline_ring(valid.select(*ORDER_COLUMNS, *arrival), arrival, 20).select("ring_position", "order_id")
    assert same(ring, kept.current("timeline_ring"))
    stats = kept.current("processing_stats").first()
    want = views.processing_stats(arrived, "p").first()
    assert (stats["processed_count"], stats["error_count"]) == (want["processed_count"], want["error_count"])
    assert stats["total_revenue_accepted"] == want["total_revenue_accepted"]
    assert jobs.rejects(kept).count() == want["error_count"]
    assert jobs.outcomes(kept).agg(F.sum("total")).first()[0] == arrived.count()


def test_a_replayed_first_hop_changes_nothing(spark, slices):
    """The first hop's batch comes again: the registry topic stays, and the second hop skips what it has consumed."""
    root, kept = fresh_dir(spark, "again"), jobs.open_store(spark, fresh_dir(spark, "againviews"))
    found = []
    for batch in range(2):
        jobs.run_validate_batch(kept, slices[0], 0, root)
        jobs.run_register_batch(kept, topics.read_log(spark, root, [topics.REGISTRY]), batch)
        found.append({t: sorted(map(str, kept.current(t).collect())) for t in ("registered_orders", "order_updates")})
    assert found[0] == found[1] and found[0]["registered_orders"]


def test_a_new_checkpoint_adds_to_an_existing_store(spark, slices):
    root, kept = fresh_dir(spark, "newcp"), jobs.open_store(spark, fresh_dir(spark, "newcpviews"), snapshot_every=2)
    counts = []
    for number, part in enumerate(slices[:3]):
        single = f"{root}/{number}"
        topics.write_log(part, single, topics.ORDERS, 0)
        jobs.views_job(topics.stream_log(spark, single), kept, fresh_dir(spark, "newcpstate"), once=True, ring_size=5).awaitTermination()
        stats = kept.current("processing_stats").first()
        counts.append(stats["processed_count"] + stats["error_count"])
    sizes = [part.count() for part in slices[:3]]
    assert counts == [sizes[0], sum(sizes[:2]), sum(sizes)]


def test_two_hop_stream_equals_batch(spark, slices):
    root = fresh_dir(spark, "log2")
    kept = jobs.open_store(spark, fresh_dir(spark, "registry"))
    first, second = fresh_dir(spark, "cp1"), fresh_dir(spark, "cp2")
    for number, part in enumerate(slices[:2]):
        topics.write_log(part, root, topics.ORDERS, number)
        jobs.validate_job(topics.stream_log(spark, root), kept, root, first, once=True).awaitTermination()
        jobs.register_job(topics.stream_log(spark, root, [topics.REGISTRY]), kept, second, once=True).awaitTermination()
    log = topics.read_log(spark, root, [topics.REGISTRY])
    ends = {r["partition"]: r["end_offset"] for r in topics.end_offsets(log).collect()}
    assert sum(ends.values()) == log.count()     # offsets go on densely over batches
    assert log.filter("key <> get_json_object(value, '$.order.order-id')").count() == 0

    arrived = codec.decode_orders(slices[0]).withColumn("delivery", F.lit(0)).unionByName(
        codec.decode_orders(slices[1]).withColumn("delivery", F.lit(1)))
    steps = registry.registry_steps(registry.approved(arrived), ["delivery", *views.TOPIC_ARRIVAL])
    stored = kept.current("registered_orders").withColumn("registered_at", F.unix_millis("registered_at")).withColumn(
        "updated_at", F.unix_millis("updated_at"))
    assert same(registry.registered_orders(steps), stored)
    history = kept.current("order_updates").withColumn("updated_at", F.unix_millis("updated_at"))
    assert same(registry.order_updates(steps), history)
    stats = kept.current("validation_stats").first()
    assert stats["total_validated"] + arrived.filter(~order_spec().valid()).count() == arrived.count()
    assert stats["total_approved"] == log.count()


def test_redelivered_batch_changes_nothing(spark, slices):
    kept = jobs.open_store(spark, fresh_dir(spark, "again"))
    jobs.run_views_batch(kept, slices[0], 0, ring_size=10)
    jobs.run_views_batch(kept, slices[1], 1, ring_size=10)
    before = {t: kept.current(t).collect() for t in ("orders_by_customer", "orders_by_product", "processing_stats")}
    jobs.run_views_batch(kept, slices[1], 1, ring_size=10)
    for name, rows in before.items():
        assert sorted(map(str, kept.current(name).collect())) == sorted(map(str, rows))


def test_bad_records_do_not_stop_the_stream(spark):
    root = fresh_dir(spark, "bad")
    texts = [GOOD, "bad-json", GOOD.replace('"customer-id":1', '"customer-id":0')]
    records = spark.createDataFrame([("k", t, 0, n) for n, t in enumerate(texts)],
                                    "key string, value string, partition int, offset long")
    topics.write_log(records.withColumn("timestamp", F.timestamp_millis("offset")), root, topics.ORDERS)
    kept = jobs.open_store(spark, fresh_dir(spark, "badviews"))
    jobs.views_job(topics.stream_log(spark, root), kept, fresh_dir(spark, "badcp"), once=True).awaitTermination()
    reasons = {r["offset"]: r["reason"] for r in jobs.rejects(kept).collect()}
    assert reasons == {1: "undecodable", 2: "customer_id: must be positive"}
    assert kept.current("processing_stats").first()["processed_count"] == 1


def test_conform_reads_millis_as_time(spark):
    df = spark.createDataFrame([("m", 1)], "metric string, value long")
    assert conform(df, TABLES["statistics"].schema).columns == ["metric", "value"]


def test_streams_cut_hot_keys_too(spark, slices):
    """A micro-batch whose hot customers, ids and topic partitions are cut gives what an uncut one gives."""
    found = []
    for segments in (1, 40):
        kept, root = jobs.open_store(spark, fresh_dir(spark, "cutviews")), fresh_dir(spark, "cutlog")
        jobs.run_views_batch(kept, slices[0], 0, ring_size=10, segments=segments)
        jobs.run_validate_batch(kept, slices[0], 0, root, segments=segments)
        jobs.run_register_batch(kept, topics.read_log(spark, root, [topics.REGISTRY]), 0, segments=segments)
        found.append({t: sorted(map(str, kept.current(t).collect())) for t in (
            "orders_by_customer", "registered_orders", "order_updates", "topic_offsets", "validation_stats")})
    assert found[0] == found[1]


# --- buckets, runs, seeking ----------------------------------------------------------------------------------------------


def scans(df):
    return [line for line in df._jdf.queryExecution().toString().split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]


@pytest.mark.parametrize("grows", [False, True])
def test_look_ups_open_one_bucket(spark, grows):
    spec = TableSpec("t", TABLES["statistics"].schema, ("metric",), grows, "metric")
    kept = ViewStore(spark, fresh_dir(spark, "buckets"), 3, {"t": spec}, buckets=4)
    for batch in range(11):
        kept.write("t", batch, spark.createDataFrame([(f"k{k}", batch) for k in range(batch, batch + 5)], spec.schema))
    want = {f"k{k}": min(k, 10) for k in range(15)}
    assert {r["metric"]: r["value"] for r in kept.current("t").collect()} == want
    assert {r["metric"]: r["value"] for r in kept.before("t", 6).collect()} == {f"k{k}": min(k, 5) for k in range(10)}
    for key in ("k0", "k7", "k14", "gone"):
        found = kept.lookup("t", key)
        assert [r["value"] for r in found.collect()] == ([want[key]] if key in want else [])
        assert all("PartitionFilters: [isnotnull(bucket" in line and f"EqualTo(metric,{key})" in line for line in scans(found))
    asked = spark.createDataFrame([("k3",), ("k9",), ("gone",)], "metric string")
    assert {r["metric"]: r["value"] for r in kept.lookup_many("t", asked).collect()} == {"k3": 3, "k9": 9}
    assert all("PartitionFilters: [bucket" in line for line in scans(kept.touched("t", 9, asked)))


def test_growing_tables_become_runs(spark):
    spec = TableSpec("t", TABLES["statistics"].schema, ("metric",), True, "metric")
    kept = ViewStore(spark, fresh_dir(spark, "runs"), 2, {"t": spec}, buckets=2)
    for batch in range(8):
        if batch != 5:      # a batch that wrote nothing
            kept.write("t", batch, spark.createDataFrame([(f"k{batch}", batch)], spec.schema))
    assert sorted(kept._complete_names(kept._runs("t"))) == ["0-1", "0-3", "0-7", "2-3", "6-7"] or \
        sorted(kept._complete_names(kept._runs("t"))) == ["0-1", "0-3", "0-7", "2-3", "4-7", "6-7"]
    assert kept.current("t").count() == 7 and kept.before("t", 6).count() == 5 and kept.before("t", 3).count() == 3


def test_changes_before_a_snapshot_can_be_forgotten(spark):
    spec = TableSpec("t", TABLES["statistics"].schema, ("metric",))
    kept = ViewStore(spark, fresh_dir(spark, "forget"), 2, {"t": spec})
    assert kept.forget_before_snapshot("t") == 0
    for batch in range(4):
        kept.write("t", batch, spark.createDataFrame([("a", batch), (f"k{batch}", 1)], spec.schema))
    before = sorted(map(str, kept.current("t").collect()))
    assert kept.forget_before_snapshot("t") == 3 and kept._complete(kept._changes("t"), "batch_id=") == [3]
    again = ViewStore(spark, kept.root, 2, {"t": spec})
    assert sorted(map(str, again.current("t").collect())) == before


@pytest.mark.parametrize("batch", [0, 1, 9, 10, 123, 999, 999_999_999_999])
def test_folders_from_a_batch_on(batch):
    from fnmatch import fnmatchcase

    names = topics.folders_from(batch).removeprefix("batch-{").removesuffix("}").split(",")
    for other in (0, 1, 5, 9, 10, 11, 99, 100, 122, 123, 124, 200, 999, 1000, 10**11, 999_999_999_999):
        assert any(fnmatchcase(f"{other:012d}", n) for n in names) == (other >= batch)


def test_streams_start_where_they_are_told(spark, slices):
    root = fresh_dir(spark, "seek")
    for number, part in enumerate(slices[:3]):
        topics.write_log(part, root, topics.ORDERS, number)
    log = topics.read_log(spark, root)
    ends = {r["partition"]: r["end_offset"] for r in topics.end_offsets(log).collect()}
    assert {r["batch"] for r in topics.manifest(spark, root, topics.ORDERS).collect()} == {0, 1, 2}
    assert topics.start_of(spark, root, topics.ORDERS) == (0, {})
    assert topics.start_of(spark, root, topics.ORDERS, latest=True) == (3, ends)
    nearly = {p: end - 1 for p, end in ends.items()}
    batch, wanted = topics.start_of(spark, root, topics.ORDERS, offsets=nearly)
    assert batch == 2 and wanted == nearly

    def read(messages):
        out = fresh_dir(spark, "seek-out")
        query = jobs.append_rows(messages.select("partition", "offset"), out, fresh_dir(spark, "seek-cp"), once=True)
        query.awaitTermination()
        return spark.read.schema("partition int, offset bigint").parquet(out).count(), sum(p["numInputRows"] for p in query.recentProgress)

    assert read(topics.stream_from(spark, root, topics.ORDERS))[0] == log.count()
    rows, opened = read(topics.stream_from(spark, root, topics.ORDERS, offsets=nearly))
    assert rows == len(ends) and opened <= slices[2].count()      # the first two folders are not opened
    late = log.agg(F.max("timestamp")).first()[0]
    assert read(topics.stream_from(spark, root, topics.ORDERS, since=late))[0] == log.filter(F.col("timestamp") >= F.lit(late)).count()
    assert read(topics.stream_from(spark, root, topics.ORDERS, latest=True))[0] == 0
    first = topics.peek_log(spark, root, topics.ORDERS, 5)
    assert same(first, topics.peek(log, topics.ORDERS, 5)) and all("batch-000000000000" in f for f in first.inputFiles())
    assert same(topics.peek_log(spark, root, topics.ORDERS, 5, from_beginning=False), topics.peek(log, topics.ORDERS, 5, from_beginning=False))


def test_messages_count_once_at_any_offset(spark, slices):
    kept = jobs.open_store(spark, fresh_dir(spark, "once"))
    twice = slices[0].unionByName(slices[0].withColumn("offset", F.col("offset") + 10_000))
    jobs.run_views_batch(kept, twice, 0, ring_size=5, once_per_message=True)
    jobs.run_views_batch(kept, slices[0].withColumn("offset", F.col("offset") + 50_000), 1, ring_size=5, once_per_message=True)
    stats = kept.current("processing_stats").first()
    assert stats["processed_count"] + stats["error_count"] == slices[0].count()


def test_dead_letters_of_all_jobs(spark, slices):
    root, kept = fresh_dir(spark, "dead"), jobs.open_store(spark, fresh_dir(spark, "deadstore"))
    rows = [("a", "bad-json", "orders", 0, 0), ("b", GOOD, "orders", 0, 1), ("c", GOOD, "registry", 0, 0), ("d", "nonsense", "registry", 0, 1),
            ("e", GOOD, "surprise", 0, 0), ("f", GOOD, None, 0, 1)]
    messages = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long").withColumn(
        "timestamp", F.timestamp_millis("offset"))
    jobs.run_consumer_batch(kept, messages, 0, root)
    reasons = sorted((str(r["topic"]), r["offset"], r["reason"]) for r in jobs.rejects(kept).collect())
    assert reasons == [("None", 1, "Unknown topic"), ("orders", 0, "undecodable"), ("registry", 0, "no approved order"),
                       ("registry", 1, "undecodable"), ("surprise", 0, "Unknown topic")]
    counted = {r["job"]: (r["total"], r["success"], r["errors"]) for r in jobs.outcomes(kept).collect()}
    assert counted == {"validate": (2, 1, 1), "register": (2, 0, 2), "consumer": (6, 4, 2)}
