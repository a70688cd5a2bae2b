"""Monitor reads over the views and the registry: rankings, searches, merges, global counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlens.functions.scalars import money_sum, round_half_up, try_parse_int
from orderlens.functions.specs import valid_lookup_id
from orderlens.operators.views import merge_single_rows
from orderlens.schemas import ACCEPTED, DENIED, PENDING

# fixed values: default sizes of the monitor's answers
TOP_CUSTOMERS = 100
TOP_PRODUCTS = 10
SEARCH_LIMIT = 50
TIMELINE_LIMIT = 100
STATUS_LIMIT = 100
ACTIVITY_LIMIT = 10


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows in the given order, with their rank.

    The limit runs as a top-k (each task keeps n rows); the rank is then numbered over those n rows only.
    """
    best = df.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_customers(customers: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    return top(customers, n, F.desc("total_spent"), "customer_id")


def top_products(products: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    return top(products, n, F.desc("total_revenue"), "product_id")


def ranking(df: DataFrame, by: str, tie: str, descending: bool = True, n: int | None = None) -> DataFrame:
    """Rows sorted by any column, a missing value counting as zero.

    With ``n`` it is a ranked top-k; without, a total sort, which Spark does by range partitions.
    """
    value = F.col(by) if by == tie else F.coalesce(F.col(by), F.lit(0))
    order = [value.desc() if descending else value.asc(), F.col(tie)]
    return df.orderBy(*order) if n is None else top(df, n, *order)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with one key; the comparison reaches the Parquet scan as a pushed filter."""
    return df.filter(F.col(key) == F.lit(value))


def lookup_many(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_semi")


def history(updates: DataFrame, order_id: str) -> DataFrame:
    return lookup(updates, "order_id", order_id).orderBy(F.desc("version"))


def latest(timeline: DataFrame, n: int) -> DataFrame:
    """Newest n entries by event time, ties by order id."""
    return timeline.orderBy(F.desc("timestamp"), "order_id").limit(n)


def orders_by_status(registered: DataFrame, status: str, n: int = STATUS_LIMIT) -> DataFrame:
    return registered.filter(F.col("status") == status).orderBy("order_id").limit(n)


def search_customers(customers: DataFrame, query: str = "", n: int = SEARCH_LIMIT) -> DataFrame:
    """Blank: top n. A whole number: that customer. Any other text: nothing."""
    if query == "":
        return top_customers(customers, n).drop("rank")
    return customers.filter(F.col("customer_id") == try_parse_int(F.lit(query)))


def search_products(products: DataFrame, query: str = "", n: int = SEARCH_LIMIT, pool: int | None = None) -> DataFrame:
    """Blank: top n by revenue. Otherwise ids starting with the upper-cased text, among the top ``pool`` if that is given."""
    if query == "":
        return top_products(products, n).drop("rank")
    among = products if pool is None else top_products(products, pool).drop("rank")
    return among.filter(F.col("product_id").startswith(query.upper())).orderBy(F.desc("total_revenue"), "product_id")


def filter_products(products: DataFrame, query: str) -> DataFrame:
    return products if query == "" else products.filter(F.col("product_id").contains(query.upper()))


def filter_customers(customers: DataFrame, query: str) -> DataFrame:
    """Id equality; text that does not start with a number filters nothing."""
    leading = F.regexp_extract(F.lit(query), r"^\s*([+-]?[0-9]+)", 1)
    wanted = F.when(leading != "", leading.try_cast("bigint"))
    return customers.filter(wanted.isNull() | (F.col("customer_id") == wanted))


def check_lookup_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("valid_id", valid_lookup_id("order_id"))


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.filter(F.col("status") == status)


def awaiting_decision(df: DataFrame) -> DataFrame:
    """Orders a person may still approve or deny."""
    return with_status(df, PENDING)


def timeline_with_status(timeline: DataFrame, registered: DataFrame, n: int = TIMELINE_LIMIT) -> DataFrame:
    """Newest n entries; a registered order lends its status, quantity and unit price.

    The left side has at most n rows, so it is broadcast to the registry scan as a semi join first and no
    shuffle of the registry is needed.
    """
    entries = latest(timeline, n)
    matching = registered.join(F.broadcast(entries.select("order_id")), "order_id", "left_semi")
    known = matching.select(
        "order_id", F.struct("status", "quantity", "unit_price").alias("stored"))
    joined = entries.join(known, "order_id", "left")
    for name in ("status", "quantity", "unit_price"):
        joined = joined.withColumn(
            name, F.when(F.col("stored").isNotNull(), F.col(f"stored.{name}")).otherwise(F.col(name)))
    return joined.select(*timeline.columns)


def recent_activity(timeline: DataFrame, registered: DataFrame, n: int = ACTIVITY_LIMIT) -> DataFrame:
    """The n newest of the merged timeline."""
    return timeline_with_status(timeline, registered, n)


def search_orders(requested: DataFrame, registered: DataFrame, timeline: DataFrame,
                  lookback: int | None = None) -> DataFrame:
    """For each requested order id the registered row, else its newest timeline row, else not found."""
    ids = requested.select("order_id").distinct()
    fields = ["customer_id", "product_id", "quantity", "unit_price", "total", "status"]
    stored = registered.select("order_id", F.struct(*fields).alias("stored"))
    seen = _recent_by_id(timeline, fields, lookback)
    joined = ids.join(stored, "order_id", "left").join(seen, "order_id", "left")
    found = F.coalesce("stored", "seen")
    return joined.select(
        "order_id", *[found[f].alias(f) for f in fields],
        F.when(F.col("stored").isNotNull(), "registered")
        .when(F.col("seen").isNotNull(), "timeline")
        .otherwise("not found").alias("source"),
    )


def _recent_by_id(timeline: DataFrame, fields: list[str], lookback: int | None) -> DataFrame:
    """Newest entry per id, among the newest ``lookback`` entries if that is given."""
    newest = timeline if lookback is None else latest(timeline, lookback)
    return newest.groupBy("order_id").agg(
        F.max_by(F.struct(*fields), F.struct("timestamp", *fields)).alias("seen"))


def whereabouts(requested: DataFrame, registered: DataFrame, timeline: DataFrame,
                lookback: int | None = None) -> DataFrame:
    """Where each requested id exists, with both payloads."""
    ids = requested.select("order_id").distinct()
    stored = registered.select(
        "order_id", F.col("status").alias("registered_status"), F.col("version").alias("registered_version"),
        F.lit(True).alias("r"))
    seen = _recent_by_id(timeline, ["status", "total"], lookback)
    joined = ids.join(stored, "order_id", "left").join(seen, "order_id", "left")
    return joined.select(
        "order_id", F.col("r").isNotNull().alias("in_registered"), F.col("seen").isNotNull().alias("in_timeline"),
        "registered_status", "registered_version",
        F.col("seen.status").alias("timeline_status"), F.col("seen.total").alias("timeline_total"),
    )


def apply_overrides(requested: DataFrame, timeline: DataFrame, lookback: int | None = None) -> DataFrame:
    """Manual decisions (order_id, new_status) with what became of them.

    A decision other than accepted or denied, or one whose id has no entry (among the newest ``lookback``, if
    given), is reported with applied = false. An applied one carries the row to store, at version 1.
    """
    fields = ["customer_id", "product_id", "quantity", "unit_price", "total", "timestamp"]
    seen = _recent_by_id(timeline, fields, lookback)
    joined = requested.select("order_id", "new_status").join(seen, "order_id", "left")
    applied = F.coalesce(F.col("new_status").isin(ACCEPTED, DENIED), F.lit(False)) & F.col("seen").isNotNull()
    return joined.select(
        "order_id", "new_status", applied.alias("applied"),
        *[F.when(applied, F.col(f"seen.{f}")).alias(f) for f in fields[:-1]],
        F.when(applied, F.lit(1).cast("bigint")).alias("version"),
        F.when(applied, F.col("new_status") == ACCEPTED).alias("validation_passed"),
    )


def overridden_rows(overrides: DataFrame, at: Column) -> DataFrame:
    """Rows to upsert into the registry for the applied decisions."""
    return overrides.filter("applied").select(
        "order_id", "customer_id", "product_id",
        F.coalesce("quantity", F.lit(0)).alias("quantity"),
        F.coalesce("unit_price", F.lit(0.0)).alias("unit_price"), "total",
        F.col("new_status").alias("status"), at.alias("registered_at"), at.alias("updated_at"),
        "version", "validation_passed",
    )


def global_stats(customers: DataFrame, products: DataFrame, registered: DataFrame) -> DataFrame:
    """One row of counters over all views."""
    accepted = F.col("status") == ACCEPTED
    return merge_single_rows([
        customers.agg(F.count("*").alias("customer_count"),
                      money_sum("total_spent").alias("total_customers_spent")),
        products.agg(F.count("*").alias("product_count")),
        registered.agg(
            money_sum(F.when(accepted, F.col("total"))).alias("total_revenue_accepted"),
            F.count("*").alias("registered_count"),
            F.count_if(accepted).alias("accepted_count"),
            F.count_if(F.col("status") == DENIED).alias("denied_count"),
            F.count_if(F.col("status") == PENDING).alias("pending_count"),
        ),
    ])


def status_cards(merged: DataFrame) -> DataFrame:
    """Counts per status and the approval rate (one decimal, or N/A when nothing is decided)."""
    counted = merged.agg(
        F.count_if(F.col("status") == ACCEPTED).alias("accepted"),
        F.count_if(F.col("status") == DENIED).alias("denied"),
        F.count_if(F.col("status") == PENDING).alias("pending"),
    )
    decided = F.col("accepted") + F.col("denied")
    rate = round_half_up(F.try_divide(100 * F.col("accepted"), decided), 1)
    return counted.withColumns({
        "total": decided + F.col("pending"),
        "approval_rate": F.when(decided > 0, F.concat(rate.cast("decimal(10,1)").cast("string"), F.lit("%")))
        .otherwise("N/A"),
    })


def status_deltas(changes: DataFrame) -> DataFrame:
    """Net effect of status changes (old_status, new_status) on the accepted, denied and pending counters.

    Only changes from or to pending count. All three counters are conditional sums over one pass.
    """
    old, new = F.col("old_status"), F.col("new_status")

    def into(status: str) -> Column:
        return F.count_if((old == PENDING) & (new == status)) - F.count_if((old == status) & (new == PENDING))

    leaves = (old == PENDING) & ~new.eqNullSafe(F.lit(PENDING))
    enters = ~old.eqNullSafe(F.lit(PENDING)) & (new == PENDING)
    return changes.agg(
        into(ACCEPTED).alias("accepted_delta"),
        into(DENIED).alias("denied_delta"),
        (F.count_if(enters) - F.count_if(leaves)).alias("pending_delta"),
    )
