"""Kinds built from the given tables, shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.keys import key_path_text
from entityframe.sources.staging import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_store(spark: SparkSession, **layout) -> ef.EntityStore:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return ef.EntityStore(spark, fresh_path(spark, "entities"), **layout)


# --- schemas -----------------------------------------------------------------------

CUSTOMER = ef.Schema(
    "Customer",
    {
        "c_name": ef.Field(ef.StringType(), nullable=False),
        "c_nationkey": ef.Field(ef.Int64Type()),
        "c_acctbal": ef.Field(ef.Float64Type()),
        "c_mktsegment": ef.Field(ef.StringType()),
    },
    key=ef.key_policy("Customer", id_field="c_custkey"),
)

ORDER = ef.Schema(
    "Order",
    {
        "o_orderkey": ef.Field(ef.Int64Type(), nullable=False),
        "o_custkey": ef.Field(ef.Int64Type(), nullable=False),
        "o_orderstatus": ef.Field(ef.StringType()),
        "o_totalprice": ef.Field(ef.Float64Type()),
        "o_orderdate": ef.Field(ef.TimestampType()),
        "o_orderpriority": ef.Field(ef.StringType()),
    },
    key=ef.key_policy("Order", id_field="o_orderkey", ancestors=[("Customer", "o_custkey")]),
)

# Orders with the status as namespace: three namespaces, each about a third of the rows.
ORDER_BY_STATUS = ef.Schema(
    "OrderByStatus",
    ORDER.properties,
    key=ef.key_policy(
        "OrderByStatus",
        id_field="o_orderkey",
        namespace_field="o_orderstatus",
        ancestors=[("Customer", "o_custkey")],
    ),
)

# Orders that also hold their customer's key as a property.
LINKED_ORDER = ef.Schema(
    "LinkedOrder",
    {**ORDER.properties, "customer": ef.Field(ef.KeyType())},
    key=ef.key_policy("LinkedOrder", id_field="o_orderkey"),
)

# Prices in steps, stored as null for low priorities; months, absent for pending orders.
PRICED = ef.Schema(
    "PricedOrder",
    {
        "o_orderkey": ef.Field(ef.Int64Type(), nullable=False),
        "o_totalprice": ef.Field(ef.Float64Type(), missing_policy="null"),
        "o_orderdate": ef.Field(ef.TimestampType()),
    },
    key=ef.key_policy("PricedOrder", id_field="o_orderkey"),
)
PRICED_SQL = """(SELECT o_orderkey, 'PricedOrder/n:' || o_orderkey || '/' AS entity_key,
        CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice / 10000) * 10000 END AS o_totalprice,
        CASE WHEN o_orderstatus <> 'P' THEN date_trunc('month', o_orderdate) END AS o_orderdate
      FROM orders)"""

LINE_ITEM = ef.Schema(
    "LineItem",
    {"l_quantity": ef.Field(ef.Float64Type()), "l_returnflag": ef.Field(ef.StringType())},
    key=ef.key_policy("LineItem", id_field="l_linenumber", ancestors=[("Customer", "o_custkey"), ("Order", "l_orderkey")]),
    strict=False,
)

EVENT = ef.Schema(
    "Event",
    {
        "event_id": ef.Field(ef.Int64Type(), nullable=False),
        "user_id": ef.Field(ef.Int64Type(), nullable=False),
        "ts": ef.Field(ef.TimestampType()),
        "event_type": ef.Field(ef.StringType()),
        "value": ef.Field(ef.Float64Type()),
        "props": ef.Field(ef.StringType(), indexed=False),
    },
    key=ef.key_policy("Event", id_field="event_id", ancestors=[("User", "user_id")]),
)

DOCUMENT = ef.Schema(
    "Document",
    {
        "text": ef.Field(ef.StringType(), indexed=False),
        "lang": ef.Field(ef.StringType()),
        "source": ef.Field(ef.StringType()),
        "n_chars": ef.Field(ef.Int64Type()),
        "quality": ef.Field(ef.Int64Type()),
        "toxic": ef.Field(ef.Int64Type()),
    },
    key=ef.key_policy("Document", id_field="doc_id"),
)


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with sparse quality and toxic columns."""
    return load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")


LABELLED_SQL = "documents LEFT JOIN labels USING (doc_id)"


def linked_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    spec = ef.key_policy("Customer", id_field="o_custkey")
    built = spec.build({f.name: f.dataType for f in orders.schema.fields})
    return orders.withColumn("customer", built.value)


def priced_orders(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") / 10000) * 10000.0)
    month = F.when(F.col("o_orderstatus") != "P", F.date_trunc("month", "o_orderdate"))
    return load(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice"), month.alias("o_orderdate"))


def keyed(df: DataFrame, schema: ef.Schema) -> DataFrame:
    """A plain frame with the key columns of its schema, as a scan would carry them."""
    key = schema.key_columns(df)
    return df.withColumns({fv.KEY: key.value, fv.NS: key.ns, fv.PATH: key.path})


def as_text(key: Column) -> Column:
    return key_path_text(key).alias("entity_key")


def micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp")).alias(f"{name}_us")


# --- stored kinds ------------------------------------------------------------------

_SOURCES: dict[str, tuple[ef.Schema, Callable[[SparkSession, str], DataFrame]]] = {
    "Customer": (CUSTOMER, lambda spark, sf: load(spark, sf, "customer")),
    "Order": (ORDER, lambda spark, sf: load(spark, sf, "orders")),
    "OrderByStatus": (ORDER_BY_STATUS, lambda spark, sf: load(spark, sf, "orders")),
    "LinkedOrder": (LINKED_ORDER, linked_orders),
    "PricedOrder": (PRICED, priced_orders),
    "Event": (EVENT, lambda spark, sf: load(spark, sf, "events")),
    "Document": (DOCUMENT, labelled_documents),
}
_STORED: dict[tuple[str, str, str], ef.EntityStore] = {}


def stored(spark: SparkSession, sf: str, kind: str) -> ef.KindAccessor:
    """A kind written from its whole table, once per session; for read queries only."""
    schema, source = _SOURCES[kind]
    name = (spark.sparkContext.applicationId, sf, kind)
    if name not in _STORED:
        store = new_store(spark)
        ef.write_entities(store, source(spark, sf), schema).raise_for_errors()
        _STORED[name] = store
    return ef.kind(schema=schema, store=_STORED[name])

