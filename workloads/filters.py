"""Filters, scope, projection, order, limit, distinct-on."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.keys import key_ns_code
from entityframe.operators.linked import descendants, nearest_ancestors
from entityframe.sources.staging import stage
from workloads.common import LINE_ITEM, ORDER, PRICED_SQL, as_text, keyed, load, micros, priced_orders, stored


def _events(spark: SparkSession, sf: str, *filters, **options) -> DataFrame:
    return ef.QuerySpec("Event", filters=filters, **options).apply(load(spark, sf, "events"))


def filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf, ("event_type", "=", "purchase"))
    return rows.select("event_id", "user_id", "value")


def filter_range(spark: SparkSession, sf: str) -> DataFrame:
    spec = ef.QuerySpec(
        "Line", filters=[("l_quantity", ">=", 10.0), ("l_quantity", "<", 20.0), ("l_discount", ">", 0.05)]
    )
    rows = spec.apply(load(spark, sf, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_partkey")


def filter_ne(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, ("event_type", "!=", "error")).select("event_id", "event_type")


def filter_in(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, ("event_type", "IN", ["click", "view"])).select("event_id", "event_type")


def filter_not_in(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf, ("event_type", "NOT_IN", ["click", "view"]))
    return rows.select("event_id", "event_type")


def filter_in_long(spark: SparkSession, sf: str) -> DataFrame:
    """Orders placed on a workday: a list of some 5,000 dates."""
    days = (datetime(1992, 1, 1) + timedelta(days=n) for n in range(19 * 365))
    spec = ef.QuerySpec(
        "Order", filters=[("o_orderdate", "IN", [d for d in days if d.weekday() < 5])]
    )
    return spec.apply(load(spark, sf, "orders")).select("o_orderkey", "o_custkey")


def filter_and(spark: SparkSession, sf: str) -> DataFrame:
    """Filters bound to the accessor plus filters of the call."""
    accessor = stored(spark, sf, "Event").with_scope(filters=[("event_type", "=", "purchase")])
    rows = accessor.read(filters=[("value", ">", 50.0), ("value", "<=", 90.0)])
    return rows.select("event_id", "value")


def filter_missing(spark: SparkSession, sf: str) -> DataFrame:
    """A property that is not stored never matches, whatever the comparison."""
    accessor = stored(spark, sf, "Document")
    rows = accessor.read(filters=[("quality", "!=", 1)], include_key=True)
    return rows.select(as_text(F.col(fv.KEY)), "quality")


def filter_key_value(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose key-valued property names one of three customers."""
    wanted = [ef.EntityKey((("Customer", name),)) for name in ("7", "11", "13")]
    accessor = stored(spark, sf, "LinkedOrder")
    return accessor.read(filters=[("customer", "IN", wanted)]).select("o_orderkey", "o_custkey")


def namespace_scan(spark: SparkSession, sf: str) -> DataFrame:
    accessor = stored(spark, sf, "OrderByStatus")
    return accessor.read(namespace="P").select("o_orderkey", "o_orderstatus")


def namespace_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    ancestor = ef.EntityKey((("Customer", "13"),), namespace="F")
    rows = stored(spark, sf, "OrderByStatus").read(ancestor=ancestor, include_key=True)
    return rows.select(
        as_text(F.col(fv.KEY)), key_ns_code(F.col(fv.KEY)).alias("namespace"), "o_totalprice"
    )


def descendants_many(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under any customer of the BUILDING segment."""
    customers = stored(spark, sf, "Customer").raw(filters=[("c_mktsegment", "=", "BUILDING")])
    orders = stored(spark, sf, "Order").raw()
    return descendants(orders, customers, 1).select("o_orderkey", "o_custkey")


def _line_items(spark: SparkSession, sf: str) -> DataFrame:
    owners = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    items = load(spark, sf, "lineitem")
    return keyed(items.join(owners, items.l_orderkey == owners.o_orderkey), LINE_ITEM)


def _mixed_ancestors(spark: SparkSession, sf: str, line_items: DataFrame) -> DataFrame:
    """Customers of a segment, urgent orders and returned line items: one, two and three levels deep."""
    customers = stored(spark, sf, "Customer").raw(filters=[("c_mktsegment", "=", "BUILDING")])
    orders = stored(spark, sf, "Order").raw(filters=[("o_orderpriority", "=", "1-URGENT")])
    items = line_items.filter("l_returnflag = 'R'")
    paths = [df.select(fv.NS, fv.PATH) for df in (customers, orders, items)]
    return paths[0].unionByName(paths[1]).unionByName(paths[2])


def descendants_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Line items under any of the ancestors, with the nearest one and the number of them."""
    # Line items meet their orders once: the keys are read three times.
    items = stage(_line_items(spark, sf).select(fv.NS, fv.PATH, "l_returnflag"), "items")
    found = nearest_ancestors(items, _mixed_ancestors(spark, sf, items), "nearest", "ancestors")
    return found.select(F.col(fv.PATH).alias("entity_key"), "nearest", "ancestors")


def filter_in_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose price, which may be null, is and is not in a table of prices with nulls."""
    accessor = stored(spark, sf, "PricedOrder")
    prices = priced_orders(spark, sf).filter("o_orderkey % 50 = 0").select("o_totalprice")
    found = [
        accessor.read(filters=[("o_totalprice", op, prices)]).select(F.lit(op).alias("op"), "o_orderkey", "o_totalprice")
        for op in ("IN", "NOT_IN")
    ]
    return found[0].unionByName(found[1])


def project(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "Order").read(projection=["o_orderkey", "o_orderpriority"])


def order_limit(spark: SparkSession, sf: str) -> DataFrame:
    orders = keyed(load(spark, sf, "orders"), ORDER)
    spec = ef.QuerySpec("Order", order=["-o_totalprice", "o_orderdate"], limit=100)
    return spec.apply(orders).select("o_orderkey", "o_totalprice", micros("o_orderdate"))


def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event of each user and type."""
    spec = ef.QuerySpec(
        "Event",
        order=["user_id", "event_type", "-ts"],
        distinct_on=["user_id", "event_type"],
    )
    events = load(spark, sf, "events").withColumn(fv.PATH, F.format_string("%020d", "event_id"))
    return spec.apply(events).select("user_id", "event_type", "event_id", "value")


def distinct_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Projection equal to the distinct set: plain distinct combinations."""
    spec = ef.QuerySpec(
        "Order",
        projection=["o_orderstatus", "o_orderpriority"],
        distinct_on=["o_orderstatus", "o_orderpriority"],
    )
    return spec.apply(load(spark, sf, "orders"))


QUERIES = {
    "filter_eq": filter_eq,
    "filter_range": filter_range,
    "filter_ne": filter_ne,
    "filter_in": filter_in,
    "filter_not_in": filter_not_in,
    "filter_in_long": filter_in_long,
    "filter_and": filter_and,
    "filter_missing": filter_missing,
    "filter_key_value": filter_key_value,
    "namespace_scan": namespace_scan,
    "namespace_ancestor": namespace_ancestor,
    "descendants_many": descendants_many,
    "descendants_mixed": descendants_mixed,
    "filter_in_table": filter_in_table,
    "project": project,
    "order_limit": order_limit,
    "distinct_on": distinct_on,
    "distinct_projection": distinct_projection,
}

SQL = {
    "filter_eq": "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
    "filter_range": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_partkey FROM lineitem
        WHERE l_quantity >= 10 AND l_quantity < 20 AND l_discount > 0.05::DOUBLE""",
    "filter_ne": "SELECT event_id, event_type FROM events WHERE event_type <> 'error'",
    "filter_in": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')",
    "filter_not_in": "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')",
    "filter_in_long": "SELECT o_orderkey, o_custkey FROM orders WHERE isodow(o_orderdate) <= 5",
    "filter_and": """
        SELECT event_id, value FROM events
        WHERE event_type = 'purchase' AND value > 50 AND value <= 90""",
    "filter_missing": """
        SELECT 'Document/n:' || doc_id || '/' AS entity_key, CAST(quality AS BIGINT) AS quality
        FROM documents JOIN labels USING (doc_id) WHERE quality <> 1""",
    "filter_key_value": """
        SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (7, 11, 13)""",
    "namespace_scan": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
    "namespace_ancestor": """
        SELECT 'Customer/n:' || o_custkey || '/OrderByStatus/n:' || o_orderkey || '/' AS entity_key,
               'F' AS namespace, o_totalprice
        FROM orders WHERE o_custkey = 13 AND o_orderstatus = 'F'""",
    "descendants_many": """
        SELECT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING'""",
    "descendants_mixed": """
        WITH found AS (
          SELECT 'Customer/n:' || o_custkey || '/' AS customer, 'Order/n:' || o_orderkey || '/' AS own_order,
                 'LineItem/n:' || l_linenumber || '/' AS item, c_mktsegment = 'BUILDING' AS a,
                 o_orderpriority = '1-URGENT' AS b,
                 bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey, l_linenumber) AS c
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
        SELECT customer || own_order || item AS entity_key,
               CASE WHEN c THEN customer || own_order || item WHEN b THEN customer || own_order ELSE customer END AS nearest,
               a::BIGINT + b::BIGINT + c::BIGINT AS ancestors
        FROM found WHERE a OR b OR c""",
    "filter_in_table": f"""
        WITH priced AS {PRICED_SQL}, prices AS (SELECT o_totalprice FROM priced WHERE o_orderkey % 50 = 0)
        SELECT 'IN' AS op, o_orderkey, o_totalprice FROM priced p
        WHERE EXISTS (SELECT 1 FROM prices s WHERE s.o_totalprice IS NOT DISTINCT FROM p.o_totalprice)
        UNION ALL
        SELECT 'NOT_IN', o_orderkey, o_totalprice FROM priced p
        WHERE o_totalprice IS NOT NULL AND NOT EXISTS (SELECT 1 FROM prices s WHERE s.o_totalprice = p.o_totalprice)""",
    "project": "SELECT o_orderkey, o_orderpriority FROM orders",
    "order_limit": """
        SELECT o_orderkey, o_totalprice, epoch_us(o_orderdate) AS o_orderdate_us FROM orders
        ORDER BY o_totalprice DESC, o_orderdate,
                 'Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/'
        LIMIT 100""",
    "distinct_on": """
        SELECT user_id, event_type, event_id, value FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rank
            FROM events) WHERE rank = 1""",
    "distinct_projection": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
}
