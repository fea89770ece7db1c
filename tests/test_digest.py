"""Digests stored with entities: equal exactly where the values are, whichever way they were written."""

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.logical import comparable, content_digest

NAN = float("nan")
VALUES = {
    "long": [0, 1, -1, None],
    "double": [0.0, -0.0, 1.5, NAN, None],
    "string": ["", "0", "é", None],
    "binary": [b"", b"\x00", None],
    "boolean": [True, False, None],
    "timestamp": [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1), None],
    "array<int>": [[], [None], [1, None], [None, 1], [1], [1, 1], None],
    "array<array<int>>": [[[1], [2]], [[1, 2]], [[]], [], [None], None],
    "struct<a:int,b:int>": [(None, 1), (1, None), (1, 1), (None, None), None],
    "array<struct<a:int,b:string>>": [[(1, None)], [(None, "1")], [(1, "1")], []],
    "map<string,int>": [{"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": None}, {}, None],
}


def digest_of(present, values):
    return content_digest({n: F.array_contains(present, n) for n in values}, values)


@pytest.mark.parametrize("ddl", VALUES)
def test_equal_where_values_are_equal(spark, ddl):
    kind = T._parse_datatype_string(ddl)
    rows = spark.createDataFrame(list(enumerate(VALUES[ddl])), T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
    digest = digest_of(F.array(F.lit("v")), {"v": (F.col("v"), kind)})
    both = rows.select("i", digest.alias("d"), comparable(F.col("v"), kind).alias("c"))
    pairs = both.alias("x").crossJoin(both.alias("y")).select(
        F.col("x.c").eqNullSafe(F.col("y.c")).alias("equal"), (F.col("x.d") == F.col("y.d")).alias("same"), "x.i", "y.i"
    )
    assert all(r.equal == r.same for r in pairs.collect())


def test_mixed_values_and_keys(spark):
    texts = ["1", "1.0", '"1"', '{"a":1,"b":2}', '{"b":2,"a":1}', "[1]", "null", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.parse_json("t").alias("v"))
    digests = rows.select("i", digest_of(F.array(F.lit("v")), {"v": (F.col("v"), T.VariantType())}).alias("d"), F.to_json("v").alias("c")).collect()
    for x, y in itertools.combinations(digests, 2):
        assert (x.d == y.d) == (x.c == y.c)


def test_absent_names_and_later_columns(spark):
    row = spark.range(1).select(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    a, b = (F.col("a"), T.IntegerType()), (F.col("b"), T.IntegerType())

    def of(names, values):
        return tuple(row.select(digest_of(F.array(*map(F.lit, names)).cast("array<string>"), values).alias("d")).first().d)

    assert of(["a"], {"a": a}) == of(["a"], {"a": a, "b": b})
    assert of(["a"], {"a": a, "b": b}) != of(["a", "b"], {"a": a, "b": b})
    assert of(["a"], {"a": a}) != of(["b"], {"b": a})
    assert of([], {"a": a}) == of([], {})


SCHEMA = ef.Schema(
    "Doc",
    {"n": ef.Field(ef.Int64Type()), "x": ef.Field(ef.Float64Type()), "tags": ef.Field(ef.ArrayType(ef.StringType())), "any": ef.Field(ef.ObjectType())},
    key=ef.key_policy("Doc", id_field="k"),
)
DDL = "k string, n int, x double, tags array<string>, any struct<a:int>"
ROWS = [("a", 1, 0.5, ["t"], (1,)), ("b", None, None, None, None), ("c", 3, -0.0, [], (None,))]


def actions(store, df, **options):
    plan = ef.plan_entities(store, df, SCHEMA, skip_unchanged=True, **options)
    return {r["__path__"]: r.action for r in plan.df.collect()}


def test_unchanged_however_written(store, frame):
    df = frame(ROWS, DDL)
    ef.write_entities(store, df, SCHEMA).raise_for_errors()
    assert set(actions(store, df).values()) == {"skip"}
    # Patched away and back again, and with a column that the table gains meanwhile.
    ef.patch_entities(store, frame([("a", 9)], "k string, n int"), SCHEMA, properties=["n"]).raise_for_errors()
    assert actions(store, df) == {"Doc/n:a/": "update", "Doc/n:b/": "skip", "Doc/n:c/": "skip"}
    wider = ef.Schema("Doc", {**SCHEMA.properties, "more": ef.Field(ef.StringType())}, key=SCHEMA.key)
    ef.write_entities(store, frame([("z", "m")], "k string, more string"), wider).raise_for_errors()
    ef.patch_entities(store, frame([("a", 1)], "k string, n int"), SCHEMA, properties=["n"]).raise_for_errors()
    assert set(actions(store, df).values()) == {"skip"}


def test_a_full_comparison_reads_no_property(store, frame):
    df = frame(ROWS, DDL)
    ef.write_entities(store, df, SCHEMA).raise_for_errors()
    plan = ef.plan_entities(store, df, SCHEMA, skip_unchanged=True).df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and fv.DIGEST in line and "__raw" not in line and "/data" in line]
    assert scans and all("tags" not in s.split("ReadSchema")[1] and fv.PRESENT not in s.split("ReadSchema")[1] for s in scans)


def test_without_a_stored_digest_values_are_compared(store, frame):
    from entityframe.plans.write_plan import classify, plan_rows

    df = frame(ROWS, DDL)
    ef.write_entities(store, df, SCHEMA).raise_for_errors()
    old = store.table("Doc").read().drop(fv.DIGEST)
    judged = classify(plan_rows(df, SCHEMA, buckets=3), old)
    assert {r.action for r in judged.df.collect()} == {"skip"}


def test_keys_only_does_not_read_it(store, frame):
    ef.write_entities(store, frame(ROWS, DDL), SCHEMA).raise_for_errors()
    plan = ef.read_entities(store, "Doc", keys_only=True)._jdf.queryExecution().executedPlan().toString()
    assert fv.DIGEST not in plan.split("ReadSchema")[-1]
