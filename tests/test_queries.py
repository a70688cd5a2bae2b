"""Every named query against its SQL check, and the plans of the hot paths."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from orderlens.operators import registry, views
from orderlens.plans import ORACLES, QUERIES, inputs
from orderlens.sources.feed import ORDER_ARRIVAL
from tests.oracle import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_core_queries_stay_when_the_optional_part_cannot_be_imported():
    """Whatever its import fails on, a missing library included."""
    code = ("import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))")
    said = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(driver.__file__), capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"], said.stderr[-500:]


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.schema == driver.entry(spark).schema


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_runs_while_ordered_work_is_built(spark):
    tracker, orders = spark.sparkContext.statusTracker(), registry.approved(inputs.feed(spark, SF))
    spark.sparkContext.setJobGroup("built", "built")
    try:
        steps = registry.registry_steps(orders, ORDER_ARRIVAL)
        registry.registered_orders(steps), registry.order_updates(steps), views.customer_stats(orders, ORDER_ARRIVAL)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not tracker.getJobIdsForGroup("built")


def test_customer_view_needs_one_shuffle_after_the_join(spark):
    text = plan(inputs.customers(spark, SF))
    assert text.count("Exchange hashpartitioning(customer_id") == 1


def test_registry_needs_one_shuffle_by_order_id(spark):
    text = plan(inputs.registered(spark, SF))
    assert text.count("Exchange hashpartitioning(order_id") == 1


def test_rows_are_dealt_out_once_for_ordered_work(spark):
    """What comes of the rows and the state carried over borders read the same exchange."""
    df = inputs.steps(spark, SF).rows
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    dealt = re.findall(r"(?<!Reused)Exchange hashpartitioning\(_segment#\d+, \d+\), REPARTITION_BY_COL", final)
    assert len(dealt) == 1


def test_product_view_aggregates_before_the_shuffle(spark):
    text = plan(inputs.products(spark, SF))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_scans_read_only_needed_columns(spark):
    text = plan(views.gated(inputs.feed(spark, SF)).agg(F.count_if(F.col("status") == "accepted")))
    assert "l_tax" not in text and "o_orderpriority" not in text
