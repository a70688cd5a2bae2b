"""SQL building blocks of the checks: the feed and the derived tables as common table expressions."""

from __future__ import annotations

_FEED = """
SELECT concat('ORD-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id,
       CAST(o_custkey AS INT) AS customer_id, concat('PROD-', CAST(l_partkey AS VARCHAR)) AS product_id,
       CAST(l_quantity AS INT) AS quantity, {price} AS unit_price, l_extendedprice AS total,
       epoch_ms(l_shipdate) AS timestamp,
       CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'P' THEN 'pending' ELSE 'denied' END AS status,
       l_partkey AS a1, l_suppkey AS a2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

STATUS_SET = "status IN ('pending', 'accepted', 'denied')"
GATE = (
    "(coalesce(order_id IS NOT NULL AND customer_id > 0 AND product_id IS NOT NULL AND quantity > 0 "
    f"AND unit_price > 0 AND total > 0 AND timestamp > 0 AND {STATUS_SET}, FALSE))"
)
RULES = (
    "(quantity >= 1 AND quantity <= 1000 AND total >= 1.0 AND total <= 100000.0 "
    "AND abs(total - quantity * unit_price) <= 0.01 "
    f"AND {STATUS_SET} AND customer_id > 0 AND length(product_id) > 0)"
)
CUSTOMER_ARRIVAL = "timestamp, order_id, a1, a2, total, quantity"
ORDER_ARRIVAL = "timestamp, a1, a2, total, quantity"


def arrival_desc(columns: str) -> str:
    return ", ".join(f"{c.strip()} DESC" for c in columns.split(","))


def money(expr: str) -> str:
    return f"coalesce(CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE), 0.0)"


def customers_sql(source: str, arrival: str) -> str:
    return f"""
SELECT customer_id, count(*) AS total_orders, {money('total')} AS total_spent,
       max(CASE WHEN newest = 1 THEN order_id END) AS last_order_id,
       max(CASE WHEN newest = 1 THEN timestamp END) AS last_order_timestamp,
       max(CASE WHEN oldest = 1 THEN timestamp END) AS first_order_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {arrival_desc(arrival)}) AS newest,
             row_number() OVER (PARTITION BY customer_id ORDER BY {arrival}) AS oldest FROM {source})
GROUP BY customer_id"""


def kept_sql(source: str, arrival: str) -> str:
    return f"""
SELECT * FROM (SELECT *, lag(order_id) OVER (PARTITION BY customer_id ORDER BY {arrival}) AS prev_id
               FROM {source}) WHERE prev_id IS NULL OR prev_id <> order_id"""


def products_sql(source: str) -> str:
    return f"""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, {money('total')} AS total_revenue,
       count(*) AS order_count, CAST(sum(quantity) AS DOUBLE) / count(*) AS avg_quantity,
       max(timestamp) AS last_order_timestamp
FROM {source} GROUP BY product_id"""


def steps_sql(source: str, arrival: str) -> str:
    return f"""
SELECT *, 1 + coalesce(sum(CASE WHEN changed THEN 1 ELSE 0 END)
                OVER (PARTITION BY order_id ORDER BY rn), 0) AS version
FROM (SELECT *, rn > 1 AND (previous_status <> status OR quantity <> q1 OR total <> t1) AS changed
      FROM (SELECT *, row_number() OVER k AS rn, first_value(quantity) OVER k AS q1,
                   first_value(total) OVER k AS t1, first_value(unit_price) OVER k AS p1,
                   first_value(timestamp) OVER k AS registered_at,
                   count(*) OVER (PARTITION BY order_id) AS n,
                   CASE row_number() OVER k WHEN 1 THEN NULL WHEN 2 THEN 'accepted'
                        ELSE lag(status) OVER k END AS previous_status
            FROM {source} WINDOW k AS (PARTITION BY order_id ORDER BY {arrival})))"""


def registered_sql(steps: str) -> str:
    return f"""
SELECT order_id, max(CASE WHEN rn = 1 THEN customer_id END) AS customer_id,
       max(CASE WHEN rn = 1 THEN product_id END) AS product_id, max(q1) AS quantity, max(p1) AS unit_price,
       max(t1) AS total, max(CASE WHEN n = 1 THEN 'accepted' WHEN rn = n THEN status END) AS status,
       max(registered_at) AS registered_at, max(CASE WHEN changed THEN timestamp END) AS updated_at,
       CAST(max(version) AS BIGINT) AS version, TRUE AS validation_passed
FROM {steps} GROUP BY order_id"""


def updates_sql(steps: str) -> str:
    return f"""
SELECT order_id, CAST(version AS BIGINT) AS version, previous_status, status AS new_status,
       timestamp AS updated_at, 'Status changed' AS update_reason FROM {steps} WHERE changed"""


_PLACED = """
SELECT *, row_number() OVER (PARTITION BY partition ORDER BY timestamp, order_id, a1, a2, total, quantity)
          - 1 AS "offset"
FROM (SELECT *, CAST(CAST('0x' || substr(md5(order_id), 1, 7) AS BIGINT) % 3 AS INT) AS partition FROM {source})"""

_ROUNDED = "floor(l_extendedprice / nullif(l_quantity, 0) * 100 + 0.5) / 100"

# name: (tables it builds on, SQL)
_PARTS: dict[str, tuple[str, str]] = {
    "feed": ("", _FEED.format(price=_ROUNDED)),
    "clean": ("", _FEED.format(price="l_extendedprice / nullif(l_quantity, 0)")),
    "gated": ("feed", f"SELECT * FROM feed WHERE {GATE}"),
    "cgated": ("clean", f"SELECT * FROM clean WHERE {GATE}"),
    "kept": ("gated", kept_sql("gated", CUSTOMER_ARRIVAL)),
    "customers": ("kept", customers_sql("kept", CUSTOMER_ARRIVAL)),
    "products": ("gated", products_sql("gated")),
    "approved": ("gated", f"SELECT * FROM gated WHERE {RULES}"),
    "capproved": ("cgated", f"SELECT * FROM cgated WHERE {RULES}"),
    "steps": ("approved", steps_sql("approved", ORDER_ARRIVAL)),
    "csteps": ("capproved", steps_sql("capproved", ORDER_ARRIVAL)),
    "registered": ("steps", registered_sql("steps")),
    "cregistered": ("csteps", registered_sql("csteps")),
    "updates": ("steps", updates_sql("steps")),
    "cupdates": ("csteps", updates_sql("csteps")),
    "entries": ("gated", f"""
SELECT order_id, customer_id, product_id, quantity, unit_price, total, timestamp, status
FROM (SELECT *, row_number() OVER (PARTITION BY timestamp, order_id
                ORDER BY a1 DESC, a2 DESC, total DESC, quantity DESC) AS k FROM gated) WHERE k = 1"""),
    "latest_by_id": ("feed", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {arrival_desc(ORDER_ARRIVAL)}) AS k
               FROM feed) WHERE k = 1"""),
    "placed": ("feed", _PLACED.format(source="feed")),
    "cplaced": ("clean", _PLACED.format(source="clean")),
    "recent": ("entries", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY timestamp DESC) AS k
               FROM entries) WHERE k = 1"""),
    "merged": ("entries cregistered", """
SELECT e.order_id, e.customer_id, e.product_id,
       CASE WHEN r.order_id IS NULL THEN e.quantity ELSE r.quantity END AS quantity,
       CASE WHEN r.order_id IS NULL THEN e.unit_price ELSE r.unit_price END AS unit_price, e.total, e.timestamp,
       CASE WHEN r.order_id IS NULL THEN e.status ELSE r.status END AS status
FROM (SELECT * FROM entries ORDER BY timestamp DESC, order_id LIMIT {n}) e
LEFT JOIN cregistered r ON e.order_id = r.order_id"""),
    # the event-at-a-time fold over every row; an entry is (id number) * 10^12 + (place in arrival order)
    "ring_rows": ("gated", """
SELECT *, dense_rank() OVER (ORDER BY order_id) * 1000000000000
          + row_number() OVER (ORDER BY timestamp, order_id, a1, a2, total, quantity) AS entry FROM gated"""),
    "ring": ("ring_rows", """
SELECT r.*, f.ring_position FROM (
  SELECT unnest(line) AS entry, generate_subscripts(line, 1) AS ring_position FROM (
    SELECT list_reduce(list([entry] ORDER BY entry % 1000000000000), lambda line, new:
             CASE WHEN list_contains(list_transform(line, lambda e: e // 1000000000000), new[1] // 1000000000000)
                  THEN line ELSE list_concat(new, line)[1:100] END, CAST([] AS BIGINT[])) AS line FROM ring_rows)) f
JOIN ring_rows r ON r.entry = f.entry"""),
    "raw": ("clean", """
SELECT concat(substr(h,1,8),'-',substr(h,9,4),'-',substr(h,13,4),'-',substr(h,17,4),'-',substr(h,21,12)) AS order_id,
       customer_id, product_id, quantity, unit_price, total, timestamp, status, a1, a2
FROM (SELECT *, md5(order_id) AS h FROM clean)"""),
}


def check(parts: str, body: str, **values) -> str:
    """``body`` preceded by the named tables and everything they build on."""
    order: list[str] = []

    def need(name: str) -> None:
        for parent in _PARTS[name][0].split():
            need(parent)
        if name not in order:
            order.append(name)

    for name in parts.split():
        need(name)
    defined = ", ".join(
        f"{name} AS ({_PARTS[name][1].replace('{n}', str(values.get('n', 100)))})" for name in order)
    return f"WITH {defined} {body}" if order else body
