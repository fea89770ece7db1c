"""Kind scans, chunks, pages, lookups, files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.operators.paging import with_chunks
from entityframe.sources.staging import fresh_path
from workloads.common import ORDER, PRICED_SQL, as_text, keyed, load, micros, stored


def scan_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored(spark, sf, "Event").read(include_key=True)
    return rows.select(
        as_text(F.col(fv.KEY)), "event_id", "user_id", micros("ts"), "event_type", "value", "props"
    )


def keys_only_orders(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "Order").read(keys_only=True).select(as_text(F.col(fv.KEY)))


def scan_without_key(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "Customer").read()


def chunk_numbers(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return with_chunks(orders, 1000, ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "chunk_number"
    )


def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    """Third page of 500 keys: two positions are walked through first."""
    accessor = stored(spark, sf, "Order")
    after = None
    for _ in range(2):
        after = accessor.page(500, after=after).next
    page = accessor.page(500, after=after, include_key=True)
    return page.rows.select(as_text(F.col(fv.KEY)), "o_orderkey", "o_totalprice")


def seek_page(spark: SparkSession, sf: str) -> DataFrame:
    """All pages by falling price, then month, then key; prices and months repeat and are missing."""
    accessor = stored(spark, sf, "PricedOrder").with_order("-o_totalprice", "o_orderdate")
    size = accessor.count() // 5 + 1
    pages, after = [], None
    while True:
        page = accessor.page(size, after=after, include_key=True)
        if page.next is None:
            return reduce(DataFrame.unionByName, pages)
        pages.append(page.rows.withColumn("page", F.lit(len(pages))))
        pages[-1] = pages[-1].select("page", as_text(F.col(fv.KEY)), "o_totalprice", micros("o_orderdate"))
        after = page.next


def kind_count(spark: SparkSession, sf: str) -> DataFrame:
    keys = stored(spark, sf, "Order").read(keys_only=True)
    return keys.agg(F.count(F.lit(1)).alias("entities"))


def bulk_get(spark: SparkSession, sf: str) -> DataFrame:
    """Stored orders that have a returned line item, fetched by key."""
    accessor = stored(spark, sf, "Order")
    returned = load(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey").distinct()
    owners = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    wanted = keyed(owners.join(returned, owners.o_orderkey == returned.l_orderkey, "left_semi"), ORDER)
    return accessor.store.table("Order").get(wanted).select("o_orderkey", "o_totalprice")


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV with a blank where the status is P, and read back."""
    path = fresh_path(spark, "csv")
    orders = load(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" Yes ")).otherwise("no").alias("urgent"),
    )
    ef.write_csv(orders, path)
    columns = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("placed_at", T.TimestampType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("urgent", T.BooleanType()),
        ]
    )
    return ef.read_csv(spark, path, columns).select(
        "o_orderkey", micros("placed_at"), "o_orderstatus", "urgent"
    )


QUERIES = {
    "scan_events": scan_events,
    "scan_without_key": scan_without_key,
    "keys_only_orders": keys_only_orders,
    "chunk_numbers": chunk_numbers,
    "keyset_page": keyset_page,
    "seek_page": seek_page,
    "kind_count": kind_count,
    "bulk_get": bulk_get,
    "csv_round_trip": csv_round_trip,
}

SQL = {
    "scan_events": """
        SELECT 'User/n:' || user_id || '/Event/n:' || event_id || '/' AS entity_key,
               event_id, user_id, epoch_us(ts) AS ts_us, event_type, value, props
        FROM events""",
    "scan_without_key": """
        SELECT c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "keys_only_orders": """
        SELECT 'Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/' AS entity_key
        FROM orders""",
    "chunk_numbers": """
        SELECT o_orderkey,
               (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS chunk_number
        FROM orders""",
    "keyset_page": """
        SELECT 'Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/' AS entity_key,
               o_orderkey, o_totalprice
        FROM orders ORDER BY entity_key LIMIT 500 OFFSET 1000""",
    "seek_page": f"""
        SELECT ((row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderdate NULLS FIRST, entity_key) - 1)
                // ((SELECT count(*) FROM orders) // 5 + 1))::INTEGER AS page,
               entity_key, o_totalprice, epoch_us(o_orderdate) AS o_orderdate_us
        FROM {PRICED_SQL}""",
    "kind_count": "SELECT count(*) AS entities FROM orders",
    "bulk_get": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "csv_round_trip": """
        SELECT o_orderkey, epoch_us(date_trunc('second', o_orderdate)) AS placed_at_us,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
               o_orderpriority = '1-URGENT' AS urgent
        FROM orders""",
}
