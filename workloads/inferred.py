"""Schema inference over JSON records, frames and stored kinds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.keys import key_path_text
from entityframe.operators.inference import field_profile, observed_types
from workloads.common import LABELLED_SQL, labelled_documents, load, new_store


def infer_props(spark: SparkSession, sf: str) -> DataFrame:
    """Types seen in the JSON records of all events."""
    return observed_types(load(spark, sf, "events"), "props")


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose payload differs in type from one event type to the next."""
    kind = F.col("event_type")
    payload = (
        F.when(kind == "click", F.get_json_object("props", "$.k"))
        .when(kind == "view", F.concat(F.lit('"'), kind, F.lit('"')))
        .when(kind == "signup", F.lit("true"))
        .when(kind == "purchase", F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit("]")))
        .otherwise(F.lit("null"))
    )
    extra = F.when(kind == "view", F.lit(',"note":"n"')).otherwise(F.lit(""))
    record = F.concat(F.lit('{"payload":'), payload, F.lit(',"rate":1.5'), extra, F.lit("}"))
    return load(spark, sf, "events").select("event_id", record.alias("record"))


def infer_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return field_profile(_mixed(spark, sf), "record")


def infer_schema_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The inferred schema itself, as rows."""
    report = ef.infer_schema_from_records(_mixed(spark, sf), "record", kind="Event")
    rows = [(f.name, f.dtype.name, f.nullable, f.mixed) for f in report.fields.values()]
    return spark.createDataFrame(rows, "name string, dtype string, nullable boolean, mixed boolean")


def infer_frame(spark: SparkSession, sf: str) -> DataFrame:
    report = ef.infer_schema_from_frame(labelled_documents(spark, sf), kind="Document")
    rows = [(f.name, f.dtype.name, f.nullable, report.sampled_entities) for f in report.fields.values()]
    return spark.createDataFrame(rows, "name string, dtype string, nullable boolean, sampled bigint")


def infer_then_read(spark: SparkSession, sf: str) -> DataFrame:
    """A stored kind without a declared schema, read with the inferred one."""
    store = new_store(spark)
    events = load(spark, sf, "events")
    schema = ef.Schema(
        "Loose",
        {
            "event_id": ef.Field(ef.Int64Type()),
            "bonus": ef.Field(ef.ObjectType()),
            "props": ef.Field(ef.EmbeddedEntityType(), indexed=False),
        },
        key=ef.key_policy("Loose", id_field="event_id"),
    )
    rows = events.select(
        "event_id",
        F.when(F.col("event_type") == "purchase", F.floor("value")).alias("bonus"),
        F.parse_json("props").alias("props"),
    )
    ef.write_entities(store, rows, schema).raise_for_errors()
    report = ef.infer_schema_of_kind(store, "Loose")
    read = ef.read_entities(store, "Loose", schema=report.schema)
    return read.select("event_id", "bonus", F.try_variant_get("props", "$.k", "bigint").alias("k"))


def _late_text(spark: SparkSession, sf: str) -> ef.EntityStore:
    """A kind in which one entity out of all holds text where the others hold numbers."""
    store = new_store(spark)
    events = load(spark, sf, "events")
    last = events.agg(F.max("event_id")).first()[0]
    schema = ef.Schema(
        "Late", {"event_id": ef.Field(ef.Int64Type()), "reading": ef.Field(ef.ObjectType())}, key=ef.key_policy("Late", id_field="event_id")
    )
    odd = F.col("event_id") == last
    reading = F.parse_json(F.when(odd, F.lit('"broken"')).otherwise(F.col("event_id").cast("string")))
    rows = events.select("event_id", reading.alias("reading"))
    ef.write_entities(store, rows, schema).raise_for_errors()
    return store


def infer_read_all(spark: SparkSession, sf: str) -> DataFrame:
    """Read with the schema found in all entities: no value is lost to the type of the others."""
    read = ef.read_entities(_late_text(spark, sf), "Late", infer_schema=True)
    return read.select("event_id", F.to_json("reading").alias("reading"))


def chunk_union(spark: SparkSession, sf: str) -> DataFrame:
    """All chunks of an inferred read, and all chunks of a keys-only one."""
    store = _late_text(spark, sf)
    size = store.table("Late").read().count() // 3 + 1
    full = list(ef.iter_entities(store, "Late", chunksize=size, infer_schema=True, order=["-event_id"]))
    keys = list(ef.iter_entities(store, "Late", chunksize=size, keys_only=True))
    rows = [c.select("event_id", F.to_json("reading").alias("reading"), F.lit(i).alias("chunk")) for i, c in enumerate(full)]
    paths = [c.select(key_path_text(F.col(fv.KEY)).alias("path"), F.lit(i).alias("key_chunk")) for i, c in enumerate(keys)]
    found = reduce(DataFrame.unionByName, rows).withColumn("path", F.format_string("Late/n:%d/", "event_id"))
    return found.join(reduce(DataFrame.unionByName, paths), "path")


def infer_string_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed properties become text under the string policy."""
    report = ef.infer_schema_from_records(_mixed(spark, sf), "record", kind="Event", mixed_type_policy="string")
    rows = [(f.name, f.dtype.name, f.nullable, f.mixed) for f in report.fields.values()]
    return spark.createDataFrame(rows, "name string, dtype string, nullable boolean, mixed boolean")


QUERIES = {
    "infer_read_all": infer_read_all,
    "chunk_union": chunk_union,
    "infer_string_policy": infer_string_policy,
    "infer_props": infer_props,
    "infer_mixed": infer_mixed,
    "infer_schema_fields": infer_schema_fields,
    "infer_frame": infer_frame,
    "infer_then_read": infer_then_read,
}

SQL = {
    "infer_read_all": """
        SELECT event_id, CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN '"broken"'
               ELSE CAST(event_id AS VARCHAR) END AS reading
        FROM events""",
    "chunk_union": """
        WITH n AS (SELECT count(*) // 3 + 1 AS size, max(event_id) AS last FROM events)
        SELECT event_id, CASE WHEN event_id = last THEN '"broken"' ELSE CAST(event_id AS VARCHAR) END AS reading,
               CAST((row_number() OVER (ORDER BY event_id DESC) - 1) // size AS INTEGER) AS chunk,
               'Late/n:' || event_id || '/' AS path,
               CAST((row_number() OVER (ORDER BY 'Late/n:' || event_id || '/') - 1) // size AS INTEGER) AS key_chunk
        FROM events, n""",
    "infer_string_policy": """
        SELECT 'payload' AS name, 'string' AS dtype, TRUE AS nullable, TRUE AS mixed
        UNION ALL SELECT 'rate', 'float64', FALSE, FALSE
        UNION ALL SELECT 'note', 'string', count(*) FILTER (event_type <> 'view') > 0, FALSE FROM events""",
    "infer_props": """
        SELECT key AS name, CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'int64' ELSE lower(type) END AS type,
               count(*) AS "values"
        FROM (SELECT e.key, e.type FROM events, json_each(events.props) AS e) GROUP BY ALL""",
    "infer_mixed": """
        SELECT 'payload' AS name, string_agg(t, ',' ORDER BY t) AS observed_types,
               TRUE AS nullable, TRUE AS mixed
        FROM (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'int64' WHEN 'view' THEN 'string'
                  WHEN 'signup' THEN 'bool' WHEN 'purchase' THEN 'array' ELSE 'null' END AS t FROM events)
        UNION ALL SELECT 'rate', 'float64', FALSE, FALSE
        UNION ALL SELECT 'note', 'string', count(*) FILTER (event_type <> 'view') > 0, FALSE FROM events""",
    "infer_schema_fields": """
        SELECT 'payload' AS name, 'object' AS dtype, TRUE AS nullable, TRUE AS mixed
        UNION ALL SELECT 'rate', 'float64', FALSE, FALSE
        UNION ALL SELECT 'note', 'string', count(*) FILTER (event_type <> 'view') > 0, FALSE FROM events""",
    "infer_frame": f"""
        WITH d AS (SELECT * FROM {LABELLED_SQL}), n AS (SELECT count(*) AS sampled FROM d)
        SELECT name, dtype, nullable, sampled FROM n, (
            SELECT 'doc_id' AS name, 'int64' AS dtype, count(doc_id) < count(*) AS nullable FROM d
            UNION ALL SELECT 'text', 'string', count(text) < count(*) FROM d
            UNION ALL SELECT 'lang', 'string', count(lang) < count(*) FROM d
            UNION ALL SELECT 'source', 'string', count(source) < count(*) FROM d
            UNION ALL SELECT 'n_chars', 'int64', count(n_chars) < count(*) FROM d
            UNION ALL SELECT 'quality', 'int64', count(quality) < count(*) FROM d
            UNION ALL SELECT 'toxic', 'int64', count(toxic) < count(*) FROM d)""",
    "infer_then_read": """
        SELECT event_id, CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS bonus,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
}
