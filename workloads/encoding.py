"""Type conversion, schema checks, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.keys import (
    key_error,
    key_flat_path,
    key_is_complete,
    key_json,
    key_ns_code,
    key_path_text,
    key_without_partition,
    judged_key_json,
)
from entityframe.plans.write_plan import PROPERTIES, plan_rows
from workloads.common import (
    DOCUMENT,
    LABELLED_SQL,
    ORDER,
    as_text,
    keyed,
    labelled_documents,
    load,
)


def _encoded(df: DataFrame, name: str, field: ef.Field) -> tuple[Column, Column, Column]:
    made = field.encode(name, F.col(name), df.schema[name].dataType)
    return made.value, made.present, made.error


def encode_int(spark: SparkSession, sf: str) -> DataFrame:
    """Text, fractions and plain numbers to int64; the brand text is an error."""
    parts = load(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")).alias("size_text"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.lit("12")).alias("brand"),
    )
    field = ef.Field(ef.Int64Type())
    size, _, _ = _encoded(parts, "size_text", field)
    price, _, _ = _encoded(parts, "price", field)
    brand, _, error = _encoded(parts, "brand", field)
    return parts.select(
        "p_partkey", size.alias("size"), price.alias("price"), brand.alias("brand"), error.alias("error")
    )


def encode_float(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_discount").cast("string").alias("discount_text"), "l_linenumber"
    )
    field = ef.Field(ef.Float64Type())
    text, _, error = _encoded(lines, "discount_text", field)
    number, _, _ = _encoded(lines, "l_linenumber", field)
    return lines.select(
        "l_orderkey", "l_partkey", text.alias("discount"), number.alias("line"), error.alias("error")
    )


def encode_bool(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.lit(" YES "))
        .when(F.col("event_type") == "view", F.lit("No"))
        .when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "signup", F.col("event_type"))
        .alias("flag"),
        F.floor(F.col("value") / 50).alias("number"),
    )
    field = ef.Field(ef.BoolType())
    flag, present, _ = _encoded(events, "flag", field)
    number, _, _ = _encoded(events, "number", field)
    return events.select("event_id", flag.alias("flag"), present.alias("present"), number.alias("number"))


def encode_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """Zone-less values are UTC, or New York when the type says so; nine digits of a
    second are cut to six."""
    events = load(spark, sf, "events").select(
        "event_id",
        "ts",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z")).alias("ts_text"),
    )
    plain, _, _ = _encoded(events, "ts", ef.Field(ef.TimestampType()))
    text, _, _ = _encoded(events, "ts_text", ef.Field(ef.TimestampType()))
    local, _, _ = _encoded(events, "ts", ef.Field(ef.TimestampType("America/New_York")))
    return events.select(
        "event_id",
        F.unix_micros(plain).alias("plain_us"),
        F.unix_micros(text).alias("text_us"),
        F.unix_micros(local).alias("local_us"),
    )


def decode_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """Stored whole numbers are microseconds."""
    events = load(spark, sf, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    )
    schema = ef.Schema("Event", {"event_id": ef.Field(ef.Int64Type()), "at": ef.Field(ef.TimestampType())})
    rows = schema.decode(events)
    return rows.select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at_text"))


def encode_array(spark: SparkSession, sf: str) -> DataFrame:
    """float vectors to int64 arrays (fractions cut)."""
    vectors = load(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x * F.lit(100.0)).alias("v")
    )
    value, _, error = _encoded(vectors, "v", ef.Field(ef.ArrayType(ef.Int64Type())))
    out = vectors.select("vec_id", value.alias("v"), error.alias("error"))
    return out.select(
        "vec_id",
        F.size("v").cast("bigint").alias("items"),
        F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        "error",
    )


def encode_geo(spark: SparkSession, sf: str) -> DataFrame:
    """First two items as a point; large ones are out of range."""
    vectors = load(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * 1000).alias("v")
    )
    value, _, error = _encoded(vectors, "v", ef.Field(ef.GeoPointType()))
    out = vectors.select("vec_id", value.alias("p"), error.alias("error"))
    return out.select("vec_id", F.round("p.latitude", 6).alias("latitude"), F.round("p.longitude", 6).alias("longitude"), "error")


def string_limit(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    _, _, error = _encoded(docs, "text", ef.Field(ef.StringType()))
    _, _, free = _encoded(docs, "text", ef.Field(ef.StringType(), indexed=False))
    return docs.select("doc_id", error.alias("error"), free.isNull().alias("fine_unindexed"))


def blob_limit(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").select("page_id", F.encode("html", "utf-8").alias("body"), "url")
    value, _, error = _encoded(pages, "body", ef.Field(ef.BlobType()))
    _, _, wrong = _encoded(pages, "url", ef.Field(ef.BlobType()))
    return pages.select(
        "page_id", F.octet_length(value).cast("bigint").alias("bytes"), error.alias("error"), wrong.alias("wrong_type")
    )


def encode_key(spark: SparkSession, sf: str) -> DataFrame:
    """Key JSON text as a property: ids of 0 and doubled identifiers are errors."""
    orders = load(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit('{"namespace":"'), F.col("o_orderstatus"),
            F.lit('","path":[{"kind":"Customer","id":'), F.col("o_custkey").cast("string"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(',"name":"x"')).otherwise(F.lit("")),
            F.lit("}]}"),
        ).alias("ref"),
    )
    value, _, error = _encoded(orders, "ref", ef.Field(ef.KeyType()))
    out = orders.select("o_orderkey", value.alias("k"), error.alias("error"))
    return out.select("o_orderkey", key_path_text(F.col("k")).alias("path"), key_ns_code(F.col("k")).alias("ns"), "error")


def embedded_entity(spark: SparkSession, sf: str) -> DataFrame:
    """JSON objects pass as embedded entities, bare numbers do not."""
    events = load(spark, sf, "events").select(
        "event_id",
        F.parse_json(
            F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k")).otherwise(F.col("props"))
        ).alias("props"),
    )
    value, _, error = _encoded(events, "props", ef.Field(ef.EmbeddedEntityType()))
    return events.select(
        "event_id", F.try_variant_get(value, "$.k", "bigint").alias("k"), error.alias("error")
    )


def object_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical text of pass-through objects: names sorted, so equal objects agree."""
    events = load(spark, sf, "events").select(
        "event_id",
        F.parse_json(
            F.concat(
                F.lit('{"t":"'), F.col("event_type"), F.lit('","k":'),
                F.get_json_object("props", "$.k"), F.lit("}"),
            )
        ).alias("o"),
    )
    value, _, _ = _encoded(events, "o", ef.Field(ef.ObjectType()))
    return events.select("event_id", F.to_json(value).alias("canonical"))


# --- schema checks -----------------------------------------------------------------


def required_missing(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf)
    schema = ef.Schema(
        "Document",
        {
            "text": ef.Field(ef.StringType(), nullable=False, indexed=False),
            "quality": ef.Field(ef.Int64Type(), nullable=False),
            "toxic": ef.Field(ef.Int64Type(), nullable=False),
        },
    )
    return docs.select("doc_id", schema.required_error(docs).alias("error"))


def strict_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """toxic and quality are not declared, which only matters where they hold a value."""
    docs = labelled_documents(spark, sf)
    schema = ef.Schema(
        "Document",
        {n: ef.Field(ef.StringType(), indexed=False) for n in ("text", "lang", "source", "n_chars")},
        key=ef.key_policy("Document", id_field="doc_id"),
    )
    return docs.select("doc_id", schema.unknown_error(docs).alias("error"))


def missing_policies(spark: SparkSession, sf: str) -> DataFrame:
    """The same sparse column under each policy."""
    docs = labelled_documents(spark, sf)
    made = {
        "omit": ef.Field(ef.Int64Type()),
        "nulls": ef.Field(ef.Int64Type(), missing_policy="null"),
        "error": ef.Field(ef.Int64Type(), missing_policy="error"),
        "filled": ef.Field(ef.Int64Type(), default=9),
    }
    columns = [F.col("doc_id")]
    for label, field in made.items():
        value, present, error = _encoded(docs, "quality", field)
        columns.append(value.alias(f"{label}_value"))
        columns.append(present.alias(f"{label}_present"))
        columns.append(error.isNotNull().alias(f"{label}_failed"))
    return docs.select(*columns)


def property_subset(spark: SparkSession, sf: str) -> DataFrame:
    plan = plan_rows(
        labelled_documents(spark, sf), DOCUMENT, properties=["lang", "quality"], row_index="doc_id"
    )
    return plan.df.select(
        "row_index", F.col(PROPERTIES)["lang"].alias("lang"), F.col(PROPERTIES)["quality"].alias("quality"),
        F.concat_ws(",", fv.PRESENT).alias("present"),
    )


def encode_presence(spark: SparkSession, sf: str) -> DataFrame:
    plan = plan_rows(labelled_documents(spark, sf), DOCUMENT, row_index="doc_id")
    return plan.df.select(
        "row_index",
        F.concat_ws(",", fv.PRESENT).alias("present"),
        F.concat_ws(",", fv.UNINDEXED).alias("unindexed"),
    )


def decode_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Undeclared stored properties are left out."""
    schema = ef.Schema("Document", {"lang": ef.Field(ef.StringType()), "quality": ef.Field(ef.Int64Type())})
    return schema.decode(labelled_documents(spark, sf))


def decode_loose(spark: SparkSession, sf: str) -> DataFrame:
    """Undeclared stored properties pass through."""
    schema = ef.Schema("Document", {"quality": ef.Field(ef.Int64Type())}, strict=False)
    docs = labelled_documents(spark, sf).select("doc_id", "lang", "source", "quality")
    return schema.decode(docs)


# --- keys --------------------------------------------------------------------------


def build_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Three-level keys with a constant id, a column name and an id column; the
    namespace is a column."""
    spec = ef.key_policy(
        "Order",
        id_field="o_orderkey",
        id_kind="id",
        namespace_field="o_orderpriority",
        ancestors=[("Shop", 5), ("Customer", "o_custkey")],
    )
    orders = load(spark, sf, "orders")
    built = spec.build({f.name: f.dataType for f in orders.schema.fields})
    keys = orders.select("o_orderkey", built.value.alias("k"), built.error.alias("error"))
    fine = F.col("error").isNull()
    return keys.select(
        "o_orderkey",
        F.when(fine, key_path_text(F.col("k"))).alias("path"),
        F.when(fine, key_ns_code(F.col("k"))).alias("ns"),
        F.when(fine, key_is_complete(F.col("k"))).alias("complete"),
        "error",
    )


def key_from_column(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of one column, with a namespace column."""
    spec = ef.KeySpec.from_columns("Order", "o_orderkey", id_kind="id", namespace_source="o_orderstatus")
    orders = load(spark, sf, "orders")
    built = spec.build({f.name: f.dataType for f in orders.schema.fields})
    fine = built.error.isNull()
    return orders.select("o_orderkey", F.when(fine, built.path).alias("path"), built.ns.alias("ns"), built.error.alias("error"))


def key_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Id 0 and missing names are row errors."""
    spec = ef.key_policy(
        "Order", id_field="o_orderkey", id_kind="id", ancestors=[("Priority", "parent")]
    )
    orders = load(spark, sf, "orders").withColumn(
        "parent",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("__high__"))
        .when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")),
    )
    built = spec.build({f.name: f.dataType for f in orders.schema.fields})
    return orders.select("o_orderkey", built.error.alias("error"))


def key_json_text(spark: SparkSession, sf: str) -> DataFrame:
    """Serialised, parsed again, and stripped of its partition."""
    orders = keyed(load(spark, sf, "orders"), ORDER)
    texts = orders.select("o_orderkey", F.col(fv.KEY), key_json(F.col(fv.KEY)).alias("json"))
    rows = texts.withColumn("parsed", judged_key_json(F.col("json")))
    return rows.select(
        "o_orderkey",
        "json",
        (key_json(F.col("parsed.key")) == F.col("json")).alias("same"),
        key_json(key_without_partition(F.col("parsed.key"))).alias("bare_json"),
        F.array_join(key_flat_path(F.col(fv.KEY)), ",").alias("flat"),
        F.coalesce("parsed.error", key_error(F.col(fv.KEY))).alias("error"),
    )


def row_key_choice(spark: SparkSession, sf: str) -> DataFrame:
    """A key in the row beats the recipe; where it is missing the recipe is used."""
    orders = load(spark, sf, "orders").withColumn(
        fv.KEY,
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit('{"path":[{"kind":"Archive","name":"'), F.col("o_orderkey").cast("string"), F.lit('"}]}')),
        ),
    )
    key = ORDER.key_columns(orders)
    return orders.select("o_orderkey", as_text(key.value), key.error.alias("error"))


QUERIES = {
    "encode_int": encode_int,
    "encode_float": encode_float,
    "encode_bool": encode_bool,
    "encode_timestamp": encode_timestamp,
    "decode_timestamp": decode_timestamp,
    "encode_array": encode_array,
    "encode_geo": encode_geo,
    "string_limit": string_limit,
    "blob_limit": blob_limit,
    "encode_key": encode_key,
    "embedded_entity": embedded_entity,
    "object_canonical": object_canonical,
    "required_missing": required_missing,
    "strict_unknown": strict_unknown,
    "missing_policies": missing_policies,
    "property_subset": property_subset,
    "encode_presence": encode_presence,
    "decode_strict": decode_strict,
    "decode_loose": decode_loose,
    "build_keys": build_keys,
    "key_from_column": key_from_column,
    "key_errors": key_errors,
    "key_json": key_json_text,
    "row_key_choice": row_key_choice,
}

SQL = {
    "encode_int": """
        SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CAST(trunc(p_retailprice) AS BIGINT) AS price,
               CASE WHEN p_size <= 25 THEN CAST(12 AS BIGINT) END AS brand,
               CASE WHEN p_size > 25 THEN 'cannot convert to int64: ' || p_brand END AS error
        FROM part""",
    "encode_float": """
        SELECT l_orderkey, l_partkey, l_discount AS discount, CAST(l_linenumber AS DOUBLE) AS line,
               CAST(NULL AS VARCHAR) AS error
        FROM lineitem""",
    "encode_bool": """
        SELECT event_id,
               CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE
                    WHEN 'error' THEN FALSE WHEN 'signup' THEN TRUE END AS flag,
               event_type <> 'purchase' AS present, floor(value / 50) <> 0 AS number
        FROM events""",
    "encode_timestamp": """
        SELECT event_id, epoch_us(ts) AS plain_us, epoch_us(ts) AS text_us,
               epoch_us(ts) + CASE
                   WHEN ts >= TIMESTAMP '2024-03-10 02:00:00' AND ts < TIMESTAMP '2024-11-03 01:00:00'
                   THEN 4 ELSE 5 END * 3600000000 AS local_us
        FROM events""",
    "decode_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at_text FROM events",
    "encode_array": """
        SELECT vec_id, len(embedding) AS items,
               CAST(list_sum(list_transform(embedding,
                   lambda x: CAST(trunc(CAST(x AS DOUBLE) * 100.0) AS BIGINT))) AS BIGINT) AS total,
               CAST(NULL AS VARCHAR) AS error
        FROM embeddings""",
    "encode_geo": """
        SELECT vec_id, CASE WHEN error IS NULL THEN round(lat, 6) END AS latitude,
               CASE WHEN error IS NULL THEN round(lng, 6) END AS longitude, error
        FROM (SELECT *, CASE WHEN lat NOT BETWEEN -90 AND 90 THEN 'latitude must be between -90 and 90'
                   WHEN lng NOT BETWEEN -180 AND 180 THEN 'longitude must be between -180 and 180' END AS error
              FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 1000 AS lat,
                           CAST(embedding[2] AS DOUBLE) * 1000 AS lng FROM embeddings))""",
    "string_limit": """
        SELECT doc_id, CASE WHEN octet_length(encode(text)) > 1500
                            THEN 'indexed string exceeds 1500 bytes' END AS error,
               TRUE AS fine_unindexed
        FROM documents""",
    "blob_limit": """
        SELECT page_id, octet_length(encode(html)) AS bytes,
               CASE WHEN octet_length(encode(html)) > 1500 THEN 'indexed blob exceeds 1500 bytes' END AS error,
               'cannot convert string to blob' AS wrong_type
        FROM pages""",
    "encode_key": """
        SELECT o_orderkey, CASE WHEN error IS NULL THEN 'Customer/i:' || o_custkey || '/' END AS path,
               CASE WHEN error IS NULL THEN o_orderstatus END AS ns, error
        FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'a path element has both an id and a name'
                             WHEN o_custkey = 0 THEN 'a numeric key id must not be zero' END AS error
              FROM orders)""",
    "embedded_entity": """
        SELECT event_id,
               CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
               CASE WHEN event_type = 'error' THEN 'an embedded entity must be an object' END AS error
        FROM events""",
    "object_canonical": """
        SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"t":"' || event_type || '"}' AS canonical
        FROM events""",
    "required_missing": f"""
        SELECT doc_id, CASE WHEN quality IS NULL THEN 'missing required fields: quality, toxic' END AS error
        FROM {LABELLED_SQL}""",
    "strict_unknown": f"""
        SELECT doc_id, CASE WHEN quality IS NOT NULL
                            THEN 'unknown fields for strict schema: quality, toxic' END AS error
        FROM {LABELLED_SQL}""",
    "missing_policies": f"""
        SELECT doc_id, q AS omit_value, q IS NOT NULL AS omit_present, FALSE AS omit_failed,
               q AS nulls_value, TRUE AS nulls_present, FALSE AS nulls_failed,
               q AS error_value, TRUE AS error_present, q IS NULL AS error_failed,
               coalesce(q, 9) AS filled_value, TRUE AS filled_present, FALSE AS filled_failed
        FROM (SELECT doc_id, CAST(quality AS BIGINT) AS q FROM {LABELLED_SQL})""",
    "property_subset": f"""
        SELECT doc_id AS row_index, lang, CAST(quality AS BIGINT) AS quality,
               CASE WHEN quality IS NULL THEN 'lang' ELSE 'lang,quality' END AS present
        FROM {LABELLED_SQL}""",
    "encode_presence": f"""
        SELECT doc_id AS row_index,
               CASE WHEN quality IS NULL THEN 'lang,n_chars,source,text'
                    ELSE 'lang,n_chars,quality,source,text,toxic' END AS present,
               'text' AS unindexed
        FROM {LABELLED_SQL}""",
    "decode_strict": f"SELECT lang, CAST(quality AS BIGINT) AS quality FROM {LABELLED_SQL}",
    "decode_loose": f"""
        SELECT doc_id, lang, source, CAST(quality AS BIGINT) AS quality FROM {LABELLED_SQL}""",
    "build_keys": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey <> 0 THEN 'Shop/i:5/Customer/n:' || o_custkey || '/Order/i:' || o_orderkey || '/' END AS path,
               CASE WHEN o_orderkey <> 0 THEN o_orderpriority END AS ns,
               CASE WHEN o_orderkey <> 0 THEN TRUE END AS complete,
               CASE WHEN o_orderkey = 0 THEN 'a numeric key id must not be zero' END AS error
        FROM orders""",
    "key_from_column": """
        SELECT o_orderkey, CASE WHEN o_orderkey <> 0 THEN 'Order/i:' || o_orderkey || '/' END AS path, o_orderstatus AS ns,
               CASE WHEN o_orderkey = 0 THEN 'a numeric key id must not be zero' END AS error
        FROM orders""",
    "key_errors": """
        SELECT o_orderkey, CASE
            WHEN o_orderpriority = '1-URGENT' THEN 'missing key value for parent'
            WHEN o_orderpriority = '5-LOW' THEN 'a key name must not be empty'
            WHEN o_orderpriority = '2-HIGH' THEN 'reserved key name: __high__'
            WHEN o_orderkey = 0 THEN 'a numeric key id must not be zero' END AS error
        FROM orders""",
    "key_json": """
        SELECT o_orderkey, json, TRUE AS same, json AS bare_json,
               'Customer,' || o_custkey || ',Order,' || o_orderkey AS flat, CAST(NULL AS VARCHAR) AS error
        FROM (SELECT *, '{"database":null,"namespace":null,"path":[{"id":null,"kind":"Customer","name":"'
                  || o_custkey || '"},{"id":null,"kind":"Order","name":"' || o_orderkey
                  || '"}],"project":null}' AS json FROM orders)""",
    "row_key_choice": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Archive/n:' || o_orderkey || '/'
            ELSE 'Customer/n:' || o_custkey || '/Order/n:' || o_orderkey || '/' END AS entity_key,
            CAST(NULL AS VARCHAR) AS error
        FROM orders""",
}
