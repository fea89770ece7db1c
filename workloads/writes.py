"""Write plans, reports and the tables they leave behind.

One scenario runs through most of them.  Stored: the orders that are not open.
Incoming: all orders, the urgent ones with a higher price.  So open orders are new,
urgent ones changed, the rest unchanged; every row of both tables takes part.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.plans.write_plan import duplicate_keys, plan_rows
from entityframe.sources.staging import fresh_path
from workloads.common import (
    EVENT,
    LABELLED_SQL,
    ORDER,
    ORDER_BY_STATUS,
    as_text,
    keyed,
    labelled_documents,
    load,
    micros,
    new_store,
    stored,
)

_INDEX = "o_orderkey"
#: Bytes of a row group of a streamed file: a batch is one file, read by as many tasks as it has groups.
_STREAM_ROW_GROUP = str(4 << 20)


def _closed(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").filter("o_orderstatus <> 'O'")


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 100).otherwise(
        F.col("o_totalprice")
    )
    return load(spark, sf, "orders").withColumn("o_totalprice", price)


def _store_closed(spark: SparkSession, sf: str) -> ef.KindAccessor:
    accessor = ef.kind(schema=ORDER, store=new_store(spark))
    accessor.write(_closed(spark, sf)).raise_for_errors()
    return accessor


def _plan_view(plan: ef.WritePlan) -> DataFrame:
    return plan.df.select("row_index", "action", as_text(F.col(fv.KEY)), "reason", "error", "should_write")


def _order_view(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", micros("o_orderdate"), "o_orderpriority")


def plan_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Default plan; rows without a customer's price floor are errors of the row."""
    orders = load(spark, sf, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )
    plan = plan_rows(orders, ORDER, row_index=_INDEX)
    return _plan_view(plan)


def classify_full(spark: SparkSession, sf: str) -> DataFrame:
    plan = _store_closed(spark, sf).plan_write(_incoming(spark, sf), skip_unchanged=True, row_index=_INDEX)
    return _plan_view(plan)


def classify_patch(spark: SparkSession, sf: str) -> DataFrame:
    """Patch of price and status; an all-missing row has nothing to patch."""
    rows = _incoming(spark, sf)
    low = F.col("o_orderpriority") == "5-LOW"
    for name in ("o_totalprice", "o_orderstatus"):
        rows = rows.withColumn(name, F.when(~low, F.col(name)))
    plan = _store_closed(spark, sf).plan_write(
        rows, patch=True, properties=["o_totalprice", "o_orderstatus"], skip_unchanged=True, row_index=_INDEX
    )
    return _plan_view(plan)


def insert_mode(spark: SparkSession, sf: str) -> DataFrame:
    plan = _store_closed(spark, sf).plan_write(
        _incoming(spark, sf), mode="insert", skip_unchanged=True, row_index=_INDEX
    )
    return _plan_view(plan)


def update_mode(spark: SparkSession, sf: str) -> DataFrame:
    plan = _store_closed(spark, sf).plan_write(
        _incoming(spark, sf), mode="update", skip_unchanged=True, row_index=_INDEX
    )
    return _plan_view(plan)


def _report_view(report: ef.WriteReport) -> DataFrame:
    return report.results.select("row_index", "action", "skipped", "dry_run", "reason", "error", "ok", "wrote")


def read_only_report(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf).with_scope(read_only=True)
    return _report_view(accessor.write(_incoming(spark, sf), skip_unchanged=True, row_index=_INDEX))


def dry_run_report(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    return _report_view(accessor.write(_incoming(spark, sf), dry_run=True, row_index=_INDEX))


def skip_unchanged_report(spark: SparkSession, sf: str) -> DataFrame:
    """Carried out: only new and changed rows are written."""
    accessor = _store_closed(spark, sf)
    return _report_view(accessor.write(_incoming(spark, sf), skip_unchanged=True, row_index=_INDEX))


def report_totals(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    report = accessor.write(_incoming(spark, sf), mode="insert", skip_unchanged=True, row_index=_INDEX)
    return report.totals_frame()


def failed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows an update cannot place, and the messages they carry."""
    accessor = _store_closed(spark, sf)
    report = accessor.write(_incoming(spark, sf), mode="update", row_index=_INDEX)
    return report.failures().select("row_index", "action", "error")


def merged_reports(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    wanted = load(spark, sf, "orders")
    open_ = accessor.write(wanted.filter("o_orderstatus = 'O'"), dry_run=True, row_index=_INDEX)
    pending = accessor.write(wanted.filter("o_orderstatus = 'P'"), read_only=True, row_index=_INDEX)
    closed = accessor.write(wanted.filter("o_orderstatus = 'F'"), mode="insert", row_index=_INDEX)
    return open_.extend(pending).extend(closed).results.select("row_index", "action", "error", "planned_write")


def duplicate_key_report(spark: SparkSession, sf: str) -> DataFrame:
    """Line items keyed by order and line number repeat keys."""
    schema = ef.Schema(
        "Line",
        {"l_quantity": ef.Field(ef.Float64Type())},
        key=ef.key_policy("Line", id_field="l_linenumber", ancestors=[("Order", "l_orderkey")]),
        strict=False,
    )
    plan = plan_rows(load(spark, sf, "lineitem"), schema)
    return duplicate_keys(plan.df, full_key=False).select(F.regexp_replace("key", "^@ ", "").alias("entity_key"), "rows")


def upsert_result(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    accessor.write(_incoming(spark, sf), skip_unchanged=True).raise_for_errors()
    return _order_view(accessor.read())


def range_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert into a kind whose partitions are ranges of keys."""
    closed = _closed(spark, sf)
    store = new_store(spark, ranges=ef.choose_ranges(closed, ORDER, 8), by_namespace=False)
    accessor = ef.kind(schema=ORDER, store=store)
    accessor.write(closed).raise_for_errors()
    accessor.write(_incoming(spark, sf), skip_unchanged=True).raise_for_errors()
    return _order_view(accessor.read())


def insert_result(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    accessor.write(_incoming(spark, sf), mode="insert")
    return _order_view(accessor.read())


def update_result(spark: SparkSession, sf: str) -> DataFrame:
    accessor = _store_closed(spark, sf)
    accessor.write(_incoming(spark, sf), mode="update")
    return _order_view(accessor.read())


def patch_result(spark: SparkSession, sf: str) -> DataFrame:
    """Prices patched; open orders come into being with the price only."""
    accessor = _store_closed(spark, sf)
    accessor.patch(_incoming(spark, sf), properties=["o_totalprice"]).raise_for_errors()
    rows = accessor.raw()
    return rows.select(
        as_text(F.col(fv.KEY)), "o_orderkey", "o_totalprice", "o_orderpriority",
        F.concat_ws(",", fv.PRESENT).alias("present"),
    )


def delete_result(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without a returned line item are left."""
    accessor = ef.kind(schema=ORDER, store=new_store(spark))
    orders = load(spark, sf, "orders")
    accessor.write(orders).raise_for_errors()
    returned = load(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    accessor.delete(keyed(orders.join(returned, "o_orderkey", "left_semi"), ORDER))
    return accessor.read().select("o_orderkey", "o_totalprice")


def delete_namespace(spark: SparkSession, sf: str) -> DataFrame:
    """One namespace of three dropped."""
    accessor = ef.kind(schema=ORDER_BY_STATUS, store=new_store(spark))
    accessor.write(load(spark, sf, "orders")).raise_for_errors()
    accessor.store.table("OrderByStatus").clear("P")
    return accessor.read().select("o_orderkey", "o_orderstatus")


def retarget_write(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded orders written to another kind; the leaf of the keys is renamed."""
    source = stored(spark, sf, "Order")
    target = new_store(spark)
    model = ef.entity_model(store=target, schema=ORDER, df=source.read())
    model.with_target(kind="OrderCopy").write().raise_for_errors()
    rows = ef.read_entities(target, "OrderCopy", include_key=True)
    return rows.select(as_text(F.col(fv.KEY)), "o_totalprice")


def audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Created where missing, modified always."""
    stamp = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    policy = ef.AuditPolicy(created_at="created_at", modified_at="modified_at", imported_at="batch_at", now=lambda: stamp)
    docs = labelled_documents(spark, sf).select(
        "doc_id",
        F.when(F.col("quality").isNotNull(), F.timestamp_seconds(F.col("doc_id"))).alias("created_at"),
        F.timestamp_seconds(F.col("doc_id")).alias("modified_at"),
    )
    return policy.apply(docs).select("doc_id", micros("created_at"), micros("modified_at"), micros("batch_at"))


COUNTER = ef.Schema(
    "Counter",
    {"user_id": ef.Field(ef.Int64Type()), "event_type": ef.Field(ef.StringType()), "value": ef.Field(ef.Float64Type())},
    key=ef.key_policy("Counter", id_field="event_type", ancestors=[("User", "user_id")]),
)


def delta_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Spending per user and type of event: stored start values, plus the values of all events
    written back as the new counters."""
    events = load(spark, sf, "events")
    counters = ef.kind(schema=COUNTER, store=new_store(spark))
    start = events.groupBy("user_id", "event_type").agg(F.max("event_id").cast("double").alias("value"))
    counters.write(start.filter("value % 3 <> 0")).raise_for_errors()
    ef.add_deltas(counters.store, COUNTER, events, "value").raise_for_errors()
    return counters.read().select("user_id", "event_type", F.round("value", 4).alias("value"))


TALLY = ef.Schema(
    "Tally",
    {
        "user_id": ef.Field(ef.Int64Type()),
        "event_type": ef.Field(ef.StringType()),
        "value": ef.Field(ef.Float64Type()),
        "peak": ef.Field(ef.Float64Type()),
        "first_at": ef.Field(ef.TimestampType()),
        "source": ef.Field(ef.Int64Type()),
        "note": ef.Field(ef.StringType()),
    },
    key=ef.key_policy("Tally", id_field="event_type", ancestors=[("User", "user_id")]),
)


def counter_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Sum, peak, first time and first source per user and type of event, merged into stored
    tallies, whose note is none of the merge's business."""
    events = load(spark, sf, "events").select(
        "user_id", "event_type", "value", F.col("value").alias("peak"), F.col("ts").alias("first_at"), F.col("event_id").alias("source")
    )
    tallies = ef.kind(schema=TALLY, store=new_store(spark))
    start = events.groupBy("user_id", "event_type").agg(F.max("source").alias("last"))
    start = start.filter("last % 3 <> 0").select(
        "user_id",
        "event_type",
        F.lit(100.0).alias("value"),
        F.when(F.col("last") % 2 == 0, F.lit(50.0)).alias("peak"),
        F.when(F.col("last") % 5 == 0, F.lit(datetime(2000, 1, 1, tzinfo=timezone.utc))).alias("first_at"),
        F.when(F.col("last") % 2 == 1, F.lit(-1)).alias("source"),
        F.concat(F.lit("note "), F.col("last").cast("string")).alias("note"),
    )
    tallies.write(start).raise_for_errors()
    rules = {"value": "add", "peak": "max", "first_at": "min", "source": "keep"}
    ef.combine_entities(tallies.store, events, TALLY, rules).raise_for_errors()
    rows = tallies.read(include_key=True)
    return rows.select(as_text(F.col(fv.KEY)), F.round("value", 4).alias("value"), "peak", micros("first_at"), "source", "note")


def bound_read(spark: SparkSession, sf: str) -> DataFrame:
    """Bound filter, order and projection, with a filter of the call added."""
    accessor = ef.kind(
        schema=ORDER,
        store=stored(spark, sf, "Order").store,
        filters=[("o_orderstatus", "=", "F")],
        projection=["o_orderkey", "o_totalprice"],
    )
    return accessor.read(filters=[("o_totalprice", ">", 200000.0)], order=["-o_totalprice"])


def bound_scope_write(spark: SparkSession, sf: str) -> DataFrame:
    """All orders against an accessor bound to one customer: each row with its verdict."""
    ancestor = ef.EntityKey((("Customer", "13"),))
    accessor = ef.kind(schema=ORDER, store=new_store(spark), ancestor=ancestor, enforce_ancestor=False)
    plan = accessor.plan_write(load(spark, sf, "orders"), row_index=_INDEX)
    return plan.scoped(ancestor).df.select("row_index", "action", "error", "should_write")


def scope_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A delete through an accessor bound to one customer: the keys outside are errors, and
    nothing is deleted."""
    accessor = ef.kind(schema=ORDER, store=new_store(spark))
    orders = load(spark, sf, "orders")
    accessor.write(orders).raise_for_errors()
    bound = accessor.with_ancestor(ef.EntityKey((("Customer", "13"),)))
    report = bound.delete(keyed(orders, ORDER))
    left = F.lit(accessor.count()).cast("long").alias("left")
    return report.results.groupBy("action", "error", "wrote").agg(F.count(F.lit(1)).alias("rows")).select("*", left)


def read_only_delete_report(spark: SparkSession, sf: str) -> DataFrame:
    """A read-only accessor reports what it would have deleted."""
    accessor = ef.kind(schema=ORDER, store=stored(spark, sf, "Order").store, read_only=True)
    report = accessor.delete(keyed(load(spark, sf, "orders"), ORDER))
    return report.results.select("row_index", "action", "error", "planned_write", "wrote")


def model_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Why frames made from a kind may not go back to it, counted over all its rows."""
    accessor = stored(spark, sf, "Order")
    model = ef.entity_model(store=accessor.store, schema=ORDER).load(keep_original=True)
    cut = model.replace_df(model.df.filter("o_orderstatus = 'F'"), lineage="closed only")
    cases = {
        "loaded": model,
        "derived": model.derive(model.df, lineage="copy"),
        "keyless": model.replace_df(model.df.select("o_totalprice")),
        "cut": cut,
        "aimed": cut.with_target(kind="Closed"),
    }
    rows = [(name, "; ".join(m.objections()) or None, " > ".join(m.lineage)) for name, m in cases.items()]
    verdicts = spark.createDataFrame(rows, "model string, objection string, lineage string")
    counts = [m.df.agg(F.count(F.lit(1)).alias("rows")).withColumn("model", F.lit(name)) for name, m in cases.items()]
    return verdicts.join(reduce(DataFrame.unionByName, counts), "model")


def round_trip_skips(spark: SparkSession, sf: str) -> DataFrame:
    """What was read is written back with skip-unchanged: every row is skipped."""
    accessor = stored(spark, sf, "Event")
    plan = accessor.plan_write(accessor.read(), skip_unchanged=True, row_index="event_id")
    return plan.df.groupBy("action", "reason").agg(F.count(F.lit(1)).alias("rows"))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """All events, split over several files and loaded one file a batch, then read back."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    store = new_store(spark)
    source = load(spark, sf, "events")
    files = fresh_path(spark, "events")
    source.repartition(3).write.option("parquet.block.size", _STREAM_ROW_GROUP).parquet(files)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(files)
    ef.start_upsert(stream, store, EVENT, checkpoint=fresh_path(spark, "stream")).awaitTermination()
    rows = ef.read_entities(store, "Event", schema=EVENT)
    return rows.select("event_id", "user_id", micros("ts"), "event_type", "value")


LATEST = ef.Schema(
    "LatestEvent",
    {"event_id": ef.Field(ef.Int64Type()), "ts": ef.Field(ef.TimestampType()), "value": ef.Field(ef.Float64Type(), nullable=False)},
    key=ef.key_policy("LatestEvent", id_field="user_id"),
)


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event of every user, from a stream with many events of a user in each batch; events
    without a user or a value are rejected.  Both tables, side by side."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    store = new_store(spark)
    bad = F.when(F.col("event_id") % 11 != 0, F.col("user_id"))
    events = load(spark, sf, "events").select(bad.alias("user_id"), "event_id", "ts", "value")
    files, rejected = fresh_path(spark, "events"), fresh_path(spark, "rejected")
    # One batch holds the later events.  Which one is read first depends on when its file was written.
    events.repartitionByRange(2, "event_id").write.option("parquet.block.size", _STREAM_ROW_GROUP).parquet(files)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    options = {"checkpoint": fresh_path(spark, "stream"), "latest_by": "event_id", "rejected": rejected}
    ef.start_upsert(stream, store, LATEST, **options).awaitTermination()
    rows = ef.read_entities(store, "LatestEvent", schema=LATEST, include_key=True)
    kept = rows.select(as_text(F.col(fv.KEY)), "event_id", F.lit(None).cast("string").alias("error"))
    failed = ef.read_rejected(store, rejected).select(
        F.lit(None).cast("string").alias("entity_key"), F.get_json_object("row", "$.event_id").cast("bigint").alias("event_id"), "error"
    )
    return kept.unionByName(failed)


QUERIES = {
    "plan_upsert": plan_upsert,
    "classify_full": classify_full,
    "classify_patch": classify_patch,
    "insert_mode": insert_mode,
    "update_mode": update_mode,
    "read_only_report": read_only_report,
    "dry_run_report": dry_run_report,
    "skip_unchanged_report": skip_unchanged_report,
    "report_totals": report_totals,
    "failed_rows": failed_rows,
    "merged_reports": merged_reports,
    "duplicate_key_report": duplicate_key_report,
    "upsert_result": upsert_result,
    "range_upsert": range_upsert,
    "insert_result": insert_result,
    "update_result": update_result,
    "patch_result": patch_result,
    "delete_result": delete_result,
    "delete_namespace": delete_namespace,
    "retarget_write": retarget_write,
    "audit_stamp": audit_stamp,
    "delta_merge": delta_merge,
    "counter_merge": counter_merge,
    "stream_latest": stream_latest,
    "bound_read": bound_read,
    "bound_scope_write": bound_scope_write,
    "scope_violations": scope_violations,
    "read_only_delete_report": read_only_delete_report,
    "model_guards": model_guards,
    "round_trip_skips": round_trip_skips,
    "stream_upsert": stream_upsert,
}

_KEY = "'Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/'"
_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, epoch_us(o_orderdate) AS o_orderdate_us, o_orderpriority"
_RAISED = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END"

SQL = {
    "plan_upsert": f"""
        SELECT o_orderkey AS row_index, CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'upsert' END AS action,
               CASE WHEN o_orderstatus <> 'P' THEN {_KEY} END AS entity_key, CAST(NULL AS VARCHAR) AS reason,
               CASE WHEN o_orderstatus = 'P' THEN 'missing required fields: o_custkey' END AS error,
               o_orderstatus <> 'P' AS should_write
        FROM orders""",
    "classify_full": f"""
        SELECT o_orderkey AS row_index,
               CASE WHEN o_orderstatus = 'O' THEN 'create' WHEN o_orderpriority = '1-URGENT' THEN 'update'
                    ELSE 'skip' END AS action,
               {_KEY} AS entity_key,
               CASE WHEN o_orderstatus = 'O' THEN 'entity does not exist'
                    WHEN o_orderpriority = '1-URGENT' THEN 'entity changed' ELSE 'entity unchanged' END AS reason,
               CAST(NULL AS VARCHAR) AS error,
               o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' AS should_write
        FROM orders""",
    "classify_patch": f"""
        SELECT o_orderkey AS row_index,
               CASE WHEN o_orderstatus = 'O' THEN 'create' WHEN o_orderpriority = '1-URGENT' THEN 'patch'
                    ELSE 'skip' END AS action,
               {_KEY} AS entity_key,
               CASE WHEN o_orderstatus = 'O' THEN 'entity does not exist'
                    WHEN o_orderpriority = '5-LOW' THEN 'no properties to patch'
                    WHEN o_orderpriority = '1-URGENT' THEN 'patch properties changed'
                    ELSE 'patch properties unchanged' END AS reason,
               CAST(NULL AS VARCHAR) AS error,
               o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' AS should_write
        FROM orders""",
    "insert_mode": f"""
        SELECT o_orderkey AS row_index, CASE WHEN o_orderstatus = 'O' THEN 'create' ELSE 'error' END AS action,
               {_KEY} AS entity_key,
               CASE WHEN o_orderstatus = 'O' THEN 'entity does not exist' END AS reason,
               CASE WHEN o_orderstatus <> 'O' THEN 'insert target already exists' END AS error,
               o_orderstatus = 'O' AS should_write
        FROM orders""",
    "update_mode": f"""
        SELECT o_orderkey AS row_index,
               CASE WHEN o_orderstatus = 'O' THEN 'error' WHEN o_orderpriority = '1-URGENT' THEN 'update'
                    ELSE 'skip' END AS action,
               {_KEY} AS entity_key,
               CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'entity changed'
                    ELSE 'entity unchanged' END AS reason,
               CASE WHEN o_orderstatus = 'O' THEN 'update target does not exist' END AS error,
               o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT' AS should_write
        FROM orders""",
    "read_only_report": """
        SELECT o_orderkey AS row_index,
               CASE WHEN o_orderstatus = 'O' THEN 'create' WHEN o_orderpriority = '1-URGENT' THEN 'update'
                    ELSE 'skip' END AS action,
               NOT w AS skipped, FALSE AS dry_run,
               CASE WHEN o_orderstatus = 'O' THEN 'entity does not exist'
                    WHEN o_orderpriority = '1-URGENT' THEN 'entity changed' ELSE 'entity unchanged' END AS reason,
               CASE WHEN w THEN 'read_only prevents write execution' END AS error,
               NOT w AS ok, FALSE AS wrote
        FROM (SELECT *, o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' AS w FROM orders)""",
    "dry_run_report": """
        SELECT o_orderkey AS row_index, 'upsert' AS action, FALSE AS skipped, TRUE AS dry_run,
               CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS error, TRUE AS ok, FALSE AS wrote
        FROM orders""",
    "skip_unchanged_report": """
        SELECT o_orderkey AS row_index, CASE WHEN w THEN 'upsert' ELSE 'skip' END AS action,
               NOT w AS skipped, FALSE AS dry_run,
               CASE WHEN o_orderstatus = 'O' THEN 'entity does not exist'
                    WHEN o_orderpriority = '1-URGENT' THEN 'entity changed' ELSE 'entity unchanged' END AS reason,
               CAST(NULL AS VARCHAR) AS error, TRUE AS ok, w AS wrote
        FROM (SELECT *, o_orderstatus = 'O' OR o_orderpriority = '1-URGENT' AS w FROM orders)""",
    "report_totals": """
        SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'O') AS succeeded,
               count(*) FILTER (o_orderstatus <> 'O') AS failed, CAST(0 AS BIGINT) AS skipped,
               count(*) FILTER (o_orderstatus = 'O') AS wrote,
               count(*) FILTER (o_orderstatus = 'O') AS planned_writes
        FROM orders""",
    "failed_rows": """
        SELECT o_orderkey AS row_index, 'error' AS action, 'update target does not exist' AS error
        FROM orders WHERE o_orderstatus = 'O'""",
    "merged_reports": """
        SELECT o_orderkey AS row_index, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'upsert' END AS action,
               CASE o_orderstatus WHEN 'P' THEN 'read_only prevents write execution'
                    WHEN 'F' THEN 'insert target already exists' END AS error,
               o_orderstatus <> 'F' AS planned_write
        FROM orders""",
    "duplicate_key_report": """
        SELECT 'Order/n:' || l_orderkey || '/Line/n:' || l_linenumber || '/' AS entity_key, count(*) AS rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "upsert_result": f"SELECT {_ORDER_COLUMNS.format(price=_RAISED)} FROM orders",
    "range_upsert": f"SELECT {_ORDER_COLUMNS.format(price=_RAISED)} FROM orders",
    "insert_result": f"""
        SELECT {_ORDER_COLUMNS.format(price=f"CASE WHEN o_orderstatus = 'O' THEN {_RAISED} ELSE o_totalprice END")}
        FROM orders""",
    "update_result": f"""
        SELECT {_ORDER_COLUMNS.format(price=_RAISED)} FROM orders WHERE o_orderstatus <> 'O'""",
    "patch_result": f"""
        SELECT {_KEY} AS entity_key, CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS o_orderkey,
               {_RAISED} AS o_totalprice, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderstatus = 'O' THEN 'o_totalprice'
                    ELSE 'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice' END AS present
        FROM orders""",
    "delete_result": """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "delete_namespace": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
    "retarget_write": """
        SELECT 'Customer/n:' || o_custkey || '/OrderCopy/n:' || o_orderkey || '/' AS entity_key, o_totalprice
        FROM orders""",
    "audit_stamp": f"""
        SELECT doc_id,
               CASE WHEN quality IS NOT NULL THEN doc_id * 1000000
                    ELSE epoch_us(TIMESTAMP '2026-01-02 03:04:05') END AS created_at_us,
               epoch_us(TIMESTAMP '2026-01-02 03:04:05') AS modified_at_us,
               epoch_us(TIMESTAMP '2026-01-02 03:04:05') AS batch_at_us
        FROM {LABELLED_SQL}""",
    "counter_merge": """
        WITH event AS (SELECT *, CASE WHEN NOT isnan(value) THEN value END AS v FROM events),
        grouped AS (
          SELECT user_id, event_type, max(event_id) AS last, coalesce(sum(v), 0) AS total, max(v) AS high,
                 min(ts) AS first_at, min(event_id) AS source
          FROM event GROUP BY user_id, event_type),
        stored AS (SELECT *, last % 3 <> 0 AS held FROM grouped)
        SELECT 'User/n:' || user_id || '/Tally/n:' || event_type || '/' AS entity_key,
               round(total + CASE WHEN held THEN 100 ELSE 0 END, 4) AS value,
               CASE WHEN held AND last % 2 = 0 THEN greatest(high, 50) ELSE high END AS peak,
               CASE WHEN held AND last % 5 = 0 THEN least(epoch_us(first_at), epoch_us(TIMESTAMP '2000-01-01')) ELSE epoch_us(first_at) END AS first_at_us,
               CASE WHEN held AND last % 2 = 1 THEN -1 ELSE source END AS source,
               CASE WHEN held THEN 'note ' || last END AS note
        FROM stored""",
    "delta_merge": """
        SELECT user_id, event_type,
               round(CASE WHEN max(event_id) % 3 <> 0 THEN max(event_id) ELSE 0 END
                     + coalesce(sum(CASE WHEN NOT isnan(value) THEN value END), 0), 4) AS value
        FROM events GROUP BY user_id, event_type""",
    "bound_read": """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000""",
    "bound_scope_write": """
        SELECT o_orderkey AS row_index, CASE WHEN o_custkey = 13 THEN 'upsert' ELSE 'error' END AS action,
               CASE WHEN o_custkey <> 13 THEN 'the key lies outside the bound ancestor' END AS error,
               o_custkey = 13 AS should_write
        FROM orders""",
    "scope_violations": """
        SELECT CASE WHEN o_custkey = 13 THEN 'delete' ELSE 'error' END AS action,
               CASE WHEN o_custkey <> 13 THEN 'the key lies outside the bound ancestor' END AS error,
               FALSE AS wrote, count(*) AS rows, (SELECT count(*) FROM orders) AS "left"
        FROM orders GROUP BY 1, 2, 3""",
    "read_only_delete_report": """
        SELECT '@ Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/' AS row_index, 'delete' AS action,
               'read_only prevents write execution' AS error, TRUE AS planned_write, FALSE AS wrote
        FROM orders""",
    "model_guards": """
        WITH n AS (SELECT count(*) AS every, count(*) FILTER (o_orderstatus = 'F') AS closed FROM orders)
        SELECT 'loaded' AS model, CAST(NULL AS VARCHAR) AS objection, '' AS lineage, every AS rows FROM n
        UNION ALL SELECT 'derived', 'a derived frame cannot go back to its source; choose a target first', 'copy', every FROM n
        UNION ALL SELECT 'keyless', 'writing back needs __key__ or all key source columns', '', every FROM n
        UNION ALL SELECT 'cut', CASE WHEN every <> closed THEN
            'the row count changed since loading; choose a target or allow_shape_change' END, 'closed only', closed FROM n
        UNION ALL SELECT 'aimed', NULL, 'closed only', closed FROM n""",
    "round_trip_skips": """
        SELECT 'skip' AS action, 'entity unchanged' AS reason, count(*) AS rows FROM events""",
    "stream_latest": """
        SELECT 'LatestEvent/n:' || user_id || '/' AS entity_key, max(event_id) AS event_id, NULL::VARCHAR AS error
        FROM events WHERE event_id % 11 <> 0 AND value IS NOT NULL AND NOT isnan(value) GROUP BY user_id
        UNION ALL
        SELECT NULL, event_id, CASE WHEN value IS NULL OR isnan(value) THEN 'missing required fields: value' ELSE 'missing key value for user_id' END
        FROM events WHERE event_id % 11 = 0 OR value IS NULL OR isnan(value)""",
    "stream_upsert": "SELECT event_id, user_id, epoch_us(ts) AS ts_us, event_type, value FROM events",
}
