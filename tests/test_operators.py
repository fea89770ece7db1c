import pytest
from pyspark.sql import functions as F, types as T

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.text import lenient_bool, slug, station_key, whole_seconds
from entityframe.operators import linked
from entityframe.operators.inference import field_profile
from entityframe.operators.paging import numbered
from entityframe.sources.staging import fresh_path


def records(frame, *texts):
    return frame(list(texts), "r string")


def test_inferred_types(frame):
    df = records(
        frame,
        '{"i":1,"f":1.5,"e":1e3,"b":true,"s":"x","a":[1],"o":{"k":1},"n":null,"m":1}',
        '{"i":2,"f":2.5,"e":2e3,"b":false,"s":"y","a":[],"o":{},"n":null,"m":"one","extra":1}',
    )
    report = ef.infer_schema_from_records(df, "r", kind="K")
    names = {n: f.dtype.name for n, f in report.fields.items()}
    assert names == {
        "i": "int64", "f": "float64", "e": "float64", "b": "bool", "s": "string", "a": "array", "o": "entity",
        "n": "object", "m": "object", "extra": "int64",
    }
    assert list(report.fields) == sorted(report.fields)
    assert report.mixed_fields == ("m",) and report.sampled_entities == 2
    nullable = {n for n, f in report.fields.items() if f.nullable}
    assert nullable == {"n", "extra"} and report.schema.strict is False
    assert report.fields["m"].observed_types == {"int64", "string"}


def test_mixed_type_policies(frame):  # T20
    df = records(frame, '{"x":1,"y":1}', '{"x":1.5,"y":"a"}')
    as_text = ef.infer_schema_from_records(df, "r", kind="K", mixed_type_policy="string")
    assert {f.dtype.name for f in as_text.fields.values()} == {"string"}
    assert as_text.mixed_fields == ("x", "y")
    with pytest.raises(ef.SchemaError, match="mixed types: float64, int64"):
        ef.infer_schema_from_records(df, "r", kind="K", mixed_type_policy="error")
    with pytest.raises(ef.SchemaError):
        ef.infer_schema_from_records(df, "r", kind="K", mixed_type_policy="other")


def test_unreadable_and_keyed_records(frame):
    df = records(frame, '{"x":1}', "{", '{"x":null,"__key__":1}')
    rows = {r["name"]: r for r in field_profile(df, "r").collect()}
    assert set(rows) == {"x"} and rows["x"].nullable and rows["x"].observed_types == "int64,null"


def test_infer_from_typed_frame(frame):
    df = frame(
        [(1, 1.0, None, [1], "x", None), (2, float("nan"), None, [2], "y", None)],
        "i int, f double, z string, a array<int>, s string, k string",
    ).withColumn("v", F.parse_json(F.when(F.col("i") == 1, F.lit("1")).otherwise(F.lit('"t"'))))
    df = df.withColumn("k", F.from_json("k", ef.KEY_TYPE)).withColumn("t", F.current_timestamp())
    report = ef.infer_schema_from_frame(df, kind="K")
    got = {n: (f.dtype.name, f.nullable, f.mixed) for n, f in report.fields.items()}
    assert got == {
        "i": ("int64", False, False), "f": ("float64", True, False), "z": ("object", True, False), "a": ("array", False, False),
        "s": ("string", False, False), "k": ("object", True, False), "v": ("object", False, True), "t": ("timestamp", False, False),
    }
    with pytest.raises(ef.SchemaError):
        ef.infer_schema_from_frame(df, kind="K", mixed_type_policy="error")


def test_concat_relaxes_types(frame):
    left = frame([(1, 1, "x")], "a int, b int, c string")
    right = frame([(2.5, True, "y")], "a double, b boolean, d string")
    both = ef.concat([left, right])
    assert dict(both.dtypes) == {"a": "double", "b": "variant", "c": "string", "d": "string"}
    assert both.count() == 2
    text = ef.concat([left, right], mixed_type_policy="string")
    assert sorted(r.b for r in text.collect()) == ["1", "true"]
    with pytest.raises(ef.SchemaError):
        ef.concat([left, right], mixed_type_policy="error")
    assert dict(ef.concat([left, left.withColumn("a", F.col("a").cast("bigint"))]).dtypes)["a"] == "bigint"
    with pytest.raises(ef.SchemaError):
        ef.concat([])


def keyed(df, spec):
    made = spec.build({f.name: f.dataType for f in df.schema.fields})
    return df.withColumns({fv.KEY: made.value, fv.NS: made.ns, fv.PATH: made.path})


def test_links(frame):
    users = keyed(frame(["u1", "u2"], "u string"), ef.key_policy("User", id_field="u"))
    rows = frame([("u1", "s1", "u1"), ("u1", "s2", "u9"), ("u2", "s3", None)], "u string, s string, ref string")
    sessions = keyed(rows, ef.key_policy("Session", id_field="s", ancestors=[("User", "u")]))
    ref = ef.key_policy("User", id_field="ref").build({f.name: f.dataType for f in rows.schema.fields})
    sessions = sessions.withColumn("ref_key", F.when(F.col("ref").isNotNull(), ref.value))

    def names(df):
        return sorted(r.s for r in df.collect())

    assert names(linked.follow_references(sessions, "ref_key", users)) == ["s1"]
    assert names(linked.dangling_references(sessions, "ref_key", users)) == ["s2"]
    counts = linked.dangling_reference_counts(sessions, "ref_key", users).collect()
    assert [(r[fv.PATH], r["rows"]) for r in counts] == [("User/n:u9/", 1)]
    assert names(linked.referencing(sessions, "ref_key", ef.EntityKey((("User", "u1"),)))) == ["s1"]
    assert names(linked.outside_ancestor_property(sessions, "ref_key")) == ["s2"]
    assert names(linked.descendants(sessions, users.filter("u = 'u1'"), 1)) == ["s1", "s2"]
    one = sessions.filter("s = 's3'").drop("ref_key")
    assert names(linked.descendants(sessions, one, 2)) == ["s3"]


def test_presence_counts(store, frame):
    df = frame([("a", 1, None), ("b", None, float("nan")), ("c", 2, 1.0)], "d string, x int, y double")
    schema = ef.Schema("D", {"x": ef.Field(ef.Int64Type()), "y": ef.Field(ef.Float64Type(), missing_policy="null")}, key=ef.key_policy("D", id_field="d"))
    ef.write_entities(store, df, schema)
    raw = ef.scan(store, ef.QuerySpec("D"))
    assert {r.property: r.entities for r in linked.presence_counts(raw).collect()} == {"x": 2, "y": 3}
    assert {r.property: r.entities for r in linked.presence_counts(df).collect()} == {"d": 3, "x": 2, "y": 1}


def test_deltas(frame):
    current = frame([("a", 10), ("b", 5)], "k string, v int")
    deltas = frame([("a", 1), ("a", 2), ("c", -4), ("a", None)], "k string, v int")
    assert {r.k: r.v for r in ef.merge_deltas(current, deltas, ["k"], "v").collect()} == {"a": 13, "b": 5, "c": -4}


def test_numbering_is_global(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("x"))
    rows = numbered(df, ["x"]).collect()
    assert sorted((r.x, r.row_number) for r in rows) == [(n, n) for n in range(1000)]
    with pytest.raises(ef.QueryValidationError):
        ef.with_chunks(df, 0, ["x"])
    assert list(ef.iter_chunks(df.filter("x < 0"), 10, ["x"])) == []


def test_texts(frame):
    df = frame([("  12 ", "A & B"), ("  ", "Étoile--9!"), (None, "x")], "i string, n string")
    assert [r[0] for r in df.select(station_key(F.col("i"), F.col("n"))).collect()] == ["12", "station-toile-9", "station-x"]
    assert df.select(slug(F.lit("--Hello  World--"))).first()[0] == "hello-world"
    flags = frame(["", " Yes", "TRUE", "1", "no", None], "f string").select(lenient_bool(F.col("f")).alias("b")).collect()
    assert [r.b for r in flags] == [None, True, True, True, False, None]
    span = frame([("2026-01-01 00:00:00.9", "2026-01-01 00:00:02.1")], "a string, b string")
    assert span.select(whole_seconds(F.col("a"), F.col("b"))).first()[0] == 1


def test_clean_rows(frame):
    df = frame([("a", 1.0, 5), (None, 1.0, 5), ("c", float("nan"), 5), ("d", 1.0, 0)], "k string, x double, n int")
    assert [r.k for r in linked.clean_rows(df, ["k", "x"], positive=["n"]).collect()] == ["a"]


def test_summarize_and_busiest(frame):
    df = frame([("a", 2, "y", 1.0), ("a", 1, None, 3.0), ("b", 3, "z", None), ("a", 4, "q", float("nan"))], "g string, o int, t string, v double")
    made = ef.summarize(df, ["g"], first={"t1": "t"}, order="o", count={"n": "v"}, mean={"m": "v"})
    assert {r.g: (r.t1, r.n, r.m) for r in made.collect()} == {"a": ("y", 2, 2.0), "b": ("z", 0, None)}
    assert ef.busiest(made, "n").first().g == "a"


def test_csv_round_trip(spark, frame):
    path = fresh_path(spark, "csv")
    df = frame([(1, "x", "Yes", "2026-01-01 00:00:00"), (2, None, None, None)], "i int, s string, b string, t string")
    ef.write_csv(df, path)
    columns = T.StructType.fromDDL("i bigint, s string, b boolean, t timestamp")
    rows = {r.i: (r.s, r.b, r.y) for r in ef.read_csv(spark, path, columns).withColumn("y", F.year("t")).collect()}
    assert rows == {1: ("x", True, 2026), 2: (None, None, None)}


def test_stream_load(spark, store, frame):
    source, checkpoint = fresh_path(spark, "source"), fresh_path(spark, "progress")
    schema = ef.Schema("D", {"v": ef.Field(ef.Int64Type())}, key=ef.key_policy("D", id_field="d"))
    frame([("a", 1), ("b", 2)], "d string, v int").write.parquet(source)

    def run():
        stream = spark.readStream.schema("d string, v int").option("maxFilesPerTrigger", 1).parquet(source)
        ef.start_upsert(stream, store, schema, checkpoint=checkpoint).awaitTermination()
        return {r[fv.PATH]: r.v for r in ef.scan(store, ef.QuerySpec("D")).collect()}

    assert run() == {"D/n:a/": 1, "D/n:b/": 2}
    frame([("b", 9), ("c", 3)], "d string, v int").write.mode("append").parquet(source)
    assert run() == {"D/n:a/": 1, "D/n:b/": 9, "D/n:c/": 3}


def test_staged_tables_are_released(spark, frame):
    from entityframe.sources.staging import stage

    before = ef.staged_count(spark)
    first, second, third = (stage(frame([i], "i int")) for i in range(3))
    assert ef.staged_count(spark) == before + 3
    assert ef.release(spark, before, newest=1) == 2 and third.first()[0] == 2
    with pytest.raises(Exception):
        spark.read.parquet(first.inputFiles()[0])
    assert ef.release(spark, before) == 1 and ef.staged_count(spark) == before
