"""What large writes leave on disk meanwhile: shuffles of one pass, no cached tables, and the same rows whatever the passes."""

import time

import pytest
from pyspark.sql import functions as F

from orderlens import session
from orderlens.functions import codec
from orderlens.operators import registry
from orderlens.schemas import ORDER
from orderlens.session import fresh_dir
from orderlens.sources import topics
from orderlens.sources.tables import ViewStore
from orderlens.streaming import jobs

ARRIVAL = ["timestamp", "order_id", "quantity"]


def feed(spark, n=300):
    """Orders of few ids, customers and products, some of them twice and some without a time or not to be taken."""
    rows = [(f"O{k % 97}", 1 + k % 7, f"P{k % 5}", 1 + k % 3, 10.0, 10.0 * (1 + k % 3), None if k % 50 == 49 else 1000 * (k % 40), ("pending", "accepted")[k % 2])
            for k in range(n)]
    return spark.createDataFrame(rows + rows[:20], ORDER)


def records(spark, n=300):
    placed = topics.assign_offsets(feed(spark, n).filter("timestamp IS NOT NULL"), ARRIVAL, key="order_id")
    return placed.select(F.col("order_id").alias("key"), codec.to_json(ORDER.names).alias("value"), "partition", "offset",
                         F.timestamp_millis("timestamp").alias("timestamp"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(k).getName() for k in range(files.size())) if f.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that have come and stay; they go a little after the query has ended."""
    for _ in range(40):
        found = shuffle_files(spark) - before
        if not found:
            return found
        time.sleep(0.25)
    return found


def lines(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same_in_passes(spark, monkeypatch, run):
    """``run`` gives the same in one pass and in several, and leaves no cached tables or work folders."""
    found = []
    for pass_rows in (session.PASS_ROWS, 120):
        monkeypatch.setattr(session, "PASS_ROWS", pass_rows)
        cached = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
        kept, tables = run()
        assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == cached
        work = spark._jvm.java.io.File(f"{kept.root}/.work".removeprefix("file:")).list()
        assert not list(work or [])
        found.append({t: lines(kept.current(t)) for t in tables})
    assert found[0] == found[1] and any(found[0].values())


@pytest.mark.parametrize("once", [False, True])
def test_views_in_passes(spark, monkeypatch, once):
    sent = records(spark).localCheckpoint()

    def run():
        kept = jobs.open_store(spark, fresh_dir(spark, "passviews"))
        for number, shift in enumerate((0, 1000)):
            jobs.run_views_batch(kept, sent.withColumn("offset", F.col("offset") + shift), number, ring_size=5, once_per_message=once)
        return kept, ["orders_by_customer", "orders_by_product", "orders_timeline", "processing_stats", "seen_messages"]

    same_in_passes(spark, monkeypatch, run)


def test_both_hops_in_passes(spark, monkeypatch):
    sent = records(spark).localCheckpoint()

    def run():
        root, kept = fresh_dir(spark, "passlog"), jobs.open_store(spark, fresh_dir(spark, "passhops"))
        for number, shift in enumerate((0, 1000)):
            jobs.run_validate_batch(kept, sent.withColumn("offset", F.col("offset") + shift), number, root)
            jobs.run_register_batch(kept, topics.read_batch(spark, root, topics.REGISTRY, number), number)
        log = topics.read_log(spark, root, [topics.REGISTRY])
        assert log.count() == log.select("partition", "offset").distinct().count() == sum(r["end_offset"] for r in topics.end_offsets(log).collect())
        return kept, ["registered_orders", "order_updates", "topic_offsets", "validation_stats"]

    same_in_passes(spark, monkeypatch, run)


def test_a_consumer_caches_no_messages(spark, monkeypatch):
    sent = records(spark).localCheckpoint()
    mixed = sent.withColumn("topic", F.when(F.col("partition") == 2, "other").otherwise("orders"))

    def run():
        kept = jobs.open_store(spark, fresh_dir(spark, "passconsumer"))
        jobs.run_consumer_batch(kept, mixed, 0, fresh_dir(spark, "passout"))
        return kept, ["rejects_consumer", "batches_consumer", "batches_validate", "validation_stats"]

    same_in_passes(spark, monkeypatch, run)


def test_places_are_the_same_in_passes(spark):
    orders = feed(spark).localCheckpoint()
    want = lines(topics.assign_offsets(orders, ARRIVAL, key="order_id"))
    for cuts in ([], [0], [20_000], [5_000, 20_000, 10**9]):
        placed = topics.Placement(orders, ARRIVAL, "order_id", cuts, pass_rows=90)
        parts = placed.parts()
        assert len(parts) >= 4 and sorted(x for part in parts for x in lines(part)) == want
        assert placed.ends == {r["partition"]: r["count"] for r in topics.assign_offsets(orders, ARRIVAL, key="order_id").groupBy("partition").count().collect()}
    placed = topics.Placement(orders, ARRIVAL, "order_id", [20_000], pass_rows=90)
    early, late = ([x for part in parts for x in lines(part)] for parts in (placed.parts(before=20_000), placed.parts(since=20_000)))
    # a row without a time takes a place, and belongs to no delivery by time
    assert sorted(early + late) == [x for x in want if "timestamp=None" not in x] and len(late) == orders.filter("timestamp >= 20000").count()


def test_a_log_appears_whole_and_small(spark):
    root, sent = fresh_dir(spark, "smalllog"), records(spark).localCheckpoint()
    before = shuffle_files(spark)
    topics.write_log([sent.filter("partition <= 1"), sent.filter("partition > 1")], root, topics.ORDERS, 3)
    assert not left_behind(spark, before)
    assert lines(topics.read_log(spark, root).drop("topic")) == lines(sent)
    names = list(spark._jvm.java.io.File(f"{root}/orders".removeprefix("file:")).list())
    assert names == ["batch-000000000003"] and all(".zstd." in f for f in topics.read_log(spark, root).inputFiles())


def test_folds_by_key_in_passes(spark):
    kept = ViewStore(spark, fresh_dir(spark, "folded"))
    orders = feed(spark).filter("timestamp IS NOT NULL").localCheckpoint()
    for number, pass_rows in enumerate((10**6, 40)):
        kept.write_folded("registered_orders", number, orders, lambda part: registry.registered_orders(registry.registry_steps(part, ARRIVAL)), pass_rows)
    changes = kept.changes("registered_orders")
    first, second = (lines(changes.filter(F.col("batch_id") == n).drop("batch_id")) for n in (0, 1))
    assert first == second and len(first) == 97
