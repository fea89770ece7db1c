"""Aggregates, duplicates, unions, profiles, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.text import station_key, whole_seconds
from entityframe.operators import linked
from workloads.common import (
    CUSTOMER,
    DOCUMENT,
    LABELLED_SQL,
    ORDER,
    as_text,
    keyed,
    labelled_documents,
    linked_orders,
    load,
    new_store,
    stored,
)


def _r(name: str, places: int = 4):
    return F.round(F.col(name), places).alias(name)


def agg_count(spark: SparkSession, sf: str) -> DataFrame:
    return ef.aggregate(labelled_documents(spark, sf), ["lang", "source"], {"quality": "count"})


def agg_sum(spark: SparkSession, sf: str) -> DataFrame:
    made = ef.aggregate(load(spark, sf, "events"), ["user_id"], {"value": "sum"})
    return made.select("user_id", _r("value_sum"))


def agg_sum_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Sum over groups without any value is 0; NaN cells are skipped."""
    events = load(spark, sf, "events").withColumn(
        "spent",
        F.when(F.col("event_type") == "purchase", F.col("value"))
        .when(F.col("event_type") == "error", F.lit(float("nan"))),
    )
    made = ef.aggregate(events, ["event_type"], {"spent": "sum"})
    return made.select("event_type", _r("spent_sum"))


def agg_mean(spark: SparkSession, sf: str) -> DataFrame:
    made = ef.aggregate(
        load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {"l_extendedprice": "mean", "l_quantity": "mean"}
    )
    return made.select("l_returnflag", "l_linestatus", _r("l_extendedprice_mean", 3), _r("l_quantity_mean", 6))


def agg_min(spark: SparkSession, sf: str) -> DataFrame:
    return ef.aggregate(load(spark, sf, "orders"), ["o_custkey"], {"o_totalprice": "min", "o_orderpriority": "min"})


def agg_max(spark: SparkSession, sf: str) -> DataFrame:
    """NaN cells do not win."""
    orders = load(spark, sf, "orders").withColumn(
        "price",
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")),
    )
    return ef.aggregate(orders, ["o_orderpriority", "o_orderstatus"], {"price": "max"})


def agg_null_group(spark: SparkSession, sf: str) -> DataFrame:
    made = ef.aggregate(labelled_documents(spark, sf), ["quality"], {"n_chars": "sum", "toxic": "count", "doc_id": "max"})
    return made.select(
        F.col("quality").cast("bigint").alias("quality"), "n_chars_sum", "toxic_count", "doc_id_max"
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """First value, count and mean per group in one pass."""
    made = ef.summarize(
        load(spark, sf, "events"),
        ["user_id"],
        first={"first_type": "event_type"},
        order="event_id",
        count={"events": "event_id"},
        mean={"value_mean": "value"},
    )
    return made.select("user_id", "first_type", "events", _r("value_mean", 6))


def busiest_group(spark: SparkSession, sf: str) -> DataFrame:
    counted = ef.aggregate(load(spark, sf, "events"), ["user_id"], {"event_id": "count"})
    return ef.busiest(counted, "event_id_count", ties=["user_id"])


def presence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return linked.presence_counts(stored(spark, sf, "Document").raw())


# Documents with a cell that is missing for some rows, to order duplicates by.
def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).withColumn("doc_id", F.format_string("%012d", "doc_id"))
    return keyed(docs, DOCUMENT)


def dup_plan_first(spark: SparkSession, sf: str) -> DataFrame:
    plan = ef.plan_duplicate_cleanup(
        _duplicates(spark, sf), ["text"], order=["-quality"], row_index="doc_id"
    )
    return plan.df.select("row_index", "action", "should_write", as_text(F.col(fv.KEY)))


def dup_plan_last(spark: SparkSession, sf: str) -> DataFrame:
    plan = ef.plan_duplicate_cleanup(
        _duplicates(spark, sf), ["text"], order=["-quality", "n_chars"], keep="last", row_index="doc_id"
    )
    return plan.df.select("row_index", "action")


def dup_survivors(spark: SparkSession, sf: str) -> DataFrame:
    rows = ef.survivors(_duplicates(spark, sf), ["lang", "source", "quality"], order=["n_chars"])
    return rows.select("doc_id", "lang", "source", F.col("quality").cast("bigint").alias("quality"))


def dup_reason(spark: SparkSession, sf: str) -> DataFrame:
    """Reasons name the group; here the group is (event_type, user_id)."""
    events = keyed(
        load(spark, sf, "events").withColumn("name", F.format_string("%012d", "event_id")),
        ef.Schema("Event", key=ef.key_policy("Event", id_field="name"), strict=False),
    )
    plan = ef.plan_duplicate_cleanup(events, ["event_type", "user_id"], order=["-value"], row_index="event_id")
    return plan.df.select("row_index", "reason")


def dup_cleanup_result(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates by text deleted from a stored kind; what is left."""
    store = new_store(spark)
    accessor = ef.kind(schema=DOCUMENT, store=store)
    docs = labelled_documents(spark, sf).withColumn("doc_id", F.format_string("%012d", "doc_id"))
    accessor.write(docs).raise_for_errors()
    accessor.cleanup_duplicates(by=["text"], order=["-n_chars"], dry_run=False).raise_for_errors()
    return accessor.read(include_key=True).select(as_text(F.col(fv.KEY)), "lang", "n_chars")


def diagonal_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("int").alias("owner"), "o_totalprice"
    )
    events = load(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("double").alias("owner"), "event_type"
    )
    return ef.concat([orders, events])


def dangling_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers that are not stored: only positive balances are."""
    orders = linked_orders(spark, sf)
    customers = keyed(load(spark, sf, "customer").filter("c_acctbal > 0"), CUSTOMER)
    return linked.dangling_references(orders, "customer", customers).select("o_orderkey", "o_custkey")


def dangling_ref_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = linked_orders(spark, sf)
    customers = keyed(load(spark, sf, "customer").filter("c_acctbal > 0"), CUSTOMER)
    counted = linked.dangling_reference_counts(orders, "customer", customers)
    return counted.select(F.col(fv.PATH).alias("entity_key"), "rows")


def follow_refs(spark: SparkSession, sf: str) -> DataFrame:
    orders = stored(spark, sf, "LinkedOrder").raw()
    customers = stored(spark, sf, "Customer").raw(filters=[("c_nationkey", "=", 3)])
    return linked.follow_references(orders, "customer", customers).select("o_orderkey", "o_custkey")


def filter_by_reference(spark: SparkSession, sf: str) -> DataFrame:
    key = ef.EntityKey((("Customer", "11"),))
    orders = stored(spark, sf, "LinkedOrder").raw()
    return linked.referencing(orders, "customer", key).select("o_orderkey", "o_totalprice")


def outside_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    """Orders keyed under their customer, whose reference names another one for some."""
    orders = keyed(load(spark, sf, "orders"), ORDER)
    other = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    spec = ef.key_policy("Customer", id_field="ref")
    with_ref = orders.withColumn("ref", other)
    built = spec.build({f.name: f.dataType for f in with_ref.schema.fields})
    return linked.outside_ancestor_property(with_ref.withColumn("customer", built.value), "customer").select("o_orderkey")


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents of positive quality."""
    rows = linked.clean_rows(labelled_documents(spark, sf), ["text", "quality"], positive=["quality"])
    return rows.select("doc_id", "lang", F.col("quality").cast("bigint").alias("quality"))


def duration_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """Whole seconds between two times of a row; durations that are not positive drop."""
    length = F.round((F.col("value") - 20) * 1_000_000).cast("bigint")
    events = load(spark, sf, "events").select(
        "event_id",
        "ts",
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + length).alias("ended_at"),
    )
    timed = events.withColumn("duration_sec", whole_seconds(F.col("ts"), F.col("ended_at")))
    return linked.clean_rows(timed, ["ts", "ended_at"], positive=["duration_sec"]).select(
        "event_id", "duration_sec"
    )


def slug_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Key names from part names; the size serves as given id where it is above 40."""
    parts = load(spark, sf, "part")
    given = F.when(F.col("p_size") > 40, F.concat(F.lit("  "), F.col("p_size").cast("string"), F.lit(" ")))
    label = F.concat_ws(" & ", F.upper("p_name"), "p_brand")
    return parts.select("p_partkey", station_key(given.otherwise(F.lit(" ")), label).alias("slug"))


def model_aggregate_target(spark: SparkSession, sf: str) -> DataFrame:
    """Load, aggregate, write the result to another kind, read that kind."""
    source = stored(spark, sf, "Event")
    target = ef.Schema(
        "TypeSummary",
        {"event_type": ef.Field(ef.StringType(), nullable=False), "value_sum": ef.Field(ef.Float64Type())},
        key=ef.key_policy("TypeSummary", id_field="event_type"),
    )
    model = ef.entity_model(store=source.store, schema=source.schema).load()
    summed = model.aggregate(by=["event_type"], metrics={"value": "sum"}, target_schema=target)
    summed.write().raise_for_errors()
    read = ef.read_entities(source.store, "TypeSummary", schema=target)
    return read.select("event_type", _r("value_sum"))


QUERIES = {
    "agg_count": agg_count,
    "agg_sum": agg_sum,
    "agg_sum_empty": agg_sum_empty,
    "agg_mean": agg_mean,
    "agg_min": agg_min,
    "agg_max": agg_max,
    "agg_null_group": agg_null_group,
    "summary": summary,
    "busiest_group": busiest_group,
    "presence_counts": presence_counts,
    "dup_plan_first": dup_plan_first,
    "dup_plan_last": dup_plan_last,
    "dup_survivors": dup_survivors,
    "dup_reason": dup_reason,
    "dup_cleanup_result": dup_cleanup_result,
    "diagonal_union": diagonal_union,
    "dangling_refs": dangling_refs,
    "dangling_ref_counts": dangling_ref_counts,
    "follow_refs": follow_refs,
    "filter_by_reference": filter_by_reference,
    "outside_ancestor": outside_ancestor,
    "clean_rows": clean_rows,
    "duration_seconds": duration_seconds,
    "slug_keys": slug_keys,
    "model_aggregate_target": model_aggregate_target,
}

SQL = {
    "agg_count": f"""
        SELECT lang, source, count(quality) AS quality_count FROM {LABELLED_SQL} GROUP BY ALL""",
    "agg_sum": "SELECT user_id, round(sum(value), 4) AS value_sum FROM events GROUP BY user_id",
    "agg_sum_empty": """
        SELECT event_type, round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0), 4) AS spent_sum
        FROM events GROUP BY event_type""",
    "agg_mean": """
        SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 3) AS l_extendedprice_mean,
               round(avg(l_quantity), 6) AS l_quantity_mean
        FROM lineitem GROUP BY ALL""",
    "agg_min": """
        SELECT o_custkey, min(o_totalprice) AS o_totalprice_min, min(o_orderpriority) AS o_orderpriority_min
        FROM orders GROUP BY o_custkey""",
    "agg_max": """
        SELECT o_orderpriority, o_orderstatus,
               max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS price_max
        FROM orders GROUP BY ALL""",
    "agg_null_group": f"""
        SELECT CAST(quality AS BIGINT) AS quality, CAST(sum(n_chars) AS BIGINT) AS n_chars_sum,
               count(toxic) AS toxic_count, max(doc_id) AS doc_id_max
        FROM {LABELLED_SQL} GROUP BY quality""",
    "summary": """
        SELECT user_id, arg_min(event_type, event_id) AS first_type, count(event_id) AS events,
               round(avg(value), 6) AS value_mean
        FROM events GROUP BY user_id""",
    "busiest_group": """
        SELECT user_id, count(event_id) AS event_id_count FROM events GROUP BY user_id
        ORDER BY event_id_count DESC, user_id LIMIT 1""",
    "presence_counts": f"""
        WITH d AS (SELECT * FROM {LABELLED_SQL})
        SELECT * FROM (
            SELECT 'text' AS property, count(text) AS entities FROM d
            UNION ALL SELECT 'lang', count(lang) FROM d
            UNION ALL SELECT 'source', count(source) FROM d
            UNION ALL SELECT 'n_chars', count(n_chars) FROM d
            UNION ALL SELECT 'quality', count(quality) FROM d
            UNION ALL SELECT 'toxic', count(toxic) FROM d) WHERE entities > 0""",
    "dup_plan_first": f"""
        SELECT id AS row_index, 'delete' AS action, TRUE AS should_write,
               'Document/n:' || id || '/' AS entity_key
        FROM (SELECT printf('%012d', doc_id) AS id, row_number() OVER (
                  PARTITION BY text ORDER BY quality DESC NULLS FIRST, doc_id) AS rank
              FROM {LABELLED_SQL}) WHERE rank > 1""",
    "dup_plan_last": f"""
        SELECT id AS row_index, 'delete' AS action
        FROM (SELECT printf('%012d', doc_id) AS id, row_number() OVER (
                  PARTITION BY text
                  ORDER BY quality ASC NULLS LAST, n_chars DESC NULLS FIRST, doc_id DESC) AS rank
              FROM {LABELLED_SQL}) WHERE rank > 1""",
    "dup_survivors": f"""
        SELECT printf('%012d', doc_id) AS doc_id, lang, source, CAST(quality AS BIGINT) AS quality
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY lang, source, quality ORDER BY n_chars NULLS LAST, doc_id) AS rank
              FROM {LABELLED_SQL}) WHERE rank = 1""",
    "dup_reason": """
        SELECT event_id AS row_index,
               'duplicate group {"event_type":"' || event_type || '","user_id":' || user_id || '}' AS reason
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY event_type, user_id ORDER BY value DESC NULLS FIRST, event_id) AS rank
              FROM events) WHERE rank > 1""",
    "dup_cleanup_result": """
        SELECT 'Document/n:' || printf('%012d', doc_id) || '/' AS entity_key, lang, n_chars
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY text ORDER BY n_chars DESC NULLS FIRST, doc_id) AS rank
              FROM documents) WHERE rank = 1""",
    "diagonal_union": """
        SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS owner, o_totalprice, NULL AS event_type
        FROM orders
        UNION ALL SELECT event_id, CAST(user_id AS DOUBLE), NULL, event_type FROM events""",
    "dangling_refs": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "dangling_ref_counts": """
        SELECT 'Customer/n:' || o_custkey || '/' AS entity_key, count(*) AS rows FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
        GROUP BY o_custkey""",
    "follow_refs": """
        SELECT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_nationkey = 3""",
    "filter_by_reference": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 11",
    "outside_ancestor": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "clean_rows": """
        SELECT doc_id, lang, CAST(quality AS BIGINT) AS quality
        FROM documents JOIN labels USING (doc_id) WHERE quality > 0""",
    "duration_seconds": """
        SELECT event_id, CAST(round((value - 20) * 1000000) AS BIGINT) // 1000000 AS duration_sec
        FROM events WHERE CAST(round((value - 20) * 1000000) AS BIGINT) // 1000000 > 0""",
    "slug_keys": """
        SELECT p_partkey, CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR)
               ELSE 'station-' || trim(regexp_replace(
                   lower(upper(p_name) || ' & ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') END AS slug
        FROM part""",
    "model_aggregate_target": """
        SELECT event_type, round(sum(value), 4) AS value_sum FROM events GROUP BY event_type""",
}
