"""Membership in a table, ancestors of mixed depth, defaults per row, streams with repeated keys."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.plans.write_plan import plan_rows


# --- tables of values ---


def numbers(df, **options):
    return sorted(r.n for r in ef.QuerySpec("K", **options).apply(df).select("n").collect())


@pytest.mark.parametrize("values", [[1.0, 3.0, 3.0], [2.0, None], [None], [], [9.0]])
@pytest.mark.parametrize("op", ["IN", "NOT_IN"])
def test_a_table_is_as_its_list(frame, op, values):
    df = frame([(n, None if n % 4 == 0 else float(n)) for n in range(10)], "n int, v double")
    table = frame([(v,) for v in values], "x double")
    assert numbers(df, filters=[("v", op, table)]) == numbers(df, filters=[("v", op, values)])


def test_a_stored_null_is_not_an_absent_value(store, frame):
    schema = ef.Schema(
        "K", {"n": ef.Field(ef.Int64Type()), "a": ef.Field(ef.Int64Type(), missing_policy="null"), "b": ef.Field(ef.Int64Type())}, key=ef.key_policy("K", id_field="n")
    )
    ef.write_entities(store, frame([(1, None, None), (2, 5, 5)], "n int, a int, b int"), schema).raise_for_errors()
    accessor, null = ef.kind(schema=schema, store=store), frame([(None,)], "x int")
    assert [r.n for r in accessor.read(filters=[("a", "IN", null)]).collect()] == [1]
    assert accessor.read(filters=[("b", "IN", null)]).collect() == []
    assert [r.n for r in accessor.read(filters=[("a", "NOT_IN", null)]).collect()] == [2]


def test_with_other_filters_order_limit_and_names_that_clash(frame):
    df = frame([(n, n % 5, n) for n in range(20)], "n int, v int, x int")
    table = frame([(v,) for v in (1, 2, 2)], "x int")
    assert numbers(df, filters=[("v", "IN", table), ("n", ">", 5), ("n", "IN", frame([(7,), (11,), (13,)], "n long"))]) == [7, 11]
    assert numbers(df, filters=[("nothing", "IN", table)]) == numbers(df, filters=[("nothing", "NOT_IN", table)]) == []
    for filters in ([("v", "=", table)], [("v", "IN", df)]):
        with pytest.raises(ef.QueryValidationError):
            numbers(df, filters=filters)


def test_keys_in_a_table(store, frame, spark):
    owner = ef.key_policy("Owner", id_field="o", namespace_field="s")
    base = frame([(1, "a", None), (2, "b", None), (3, "a", "t"), (4, None, None)], "n int, o string, s string")
    built = owner.build({f.name: f.dataType for f in base.schema.fields})
    df = base.withColumn("owner", F.when(F.col("o").isNotNull(), built.value)).drop("o", "s")
    table = df.filter("n in (1, 4)").select("owner")
    assert numbers(df, filters=[("owner", "IN", table)]) == [1, 4]
    assert numbers(df, filters=[("owner", "NOT_IN", table)]) == [2, 3]
    with pytest.raises(ef.QueryValidationError):
        numbers(df, filters=[("owner", "IN", base.select("n"))])


@pytest.mark.parametrize("ddl,values", [("long", [1, 2**60 + 1]), ("double", [1.0, 2.5, None]), ("string", ["1", None]), ("boolean", [True]), ("decimal(20,2)", [None])])
def test_mixed_properties_in_a_table(spark, frame, ddl, values):
    texts = ["1", "1.0", "2.5", str(2**60), str(2**60 + 1), '"1"', "true", "null", "[1]"]
    df = frame(list(enumerate(texts)), "n int, t string").select("n", F.parse_json("t").alias("v"))
    table = frame([(v,) for v in values], f"x {ddl}")
    for op in ("IN", "NOT_IN"):
        assert numbers(df, filters=[("v", op, table)]) == numbers(df, filters=[("v", op, values)]), op


def test_a_table_is_joined_not_compared_row_by_row(frame):
    df, table = frame([(1, 1)], "n int, v int"), frame([(1,)], "x int")
    for op in ("IN", "NOT_IN"):
        plan = ef.QuerySpec("K", filters=[("v", op, table)]).apply(df)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- ancestors of mixed depth ---


def paths(frame, *rows):
    return frame([r if isinstance(r, tuple) else ("", r) for r in rows], f"{fv.NS} string, {fv.PATH} string")


def test_nearest_of_ancestors_at_any_depth(frame):
    rows = paths(frame, "A/n:1/", "A/n:1/B/n:1/", "A/n:1/B/n:1/C/n:1/", "A/n:1/B/n:2/", "A/n:10/", "A/n:2/B/n:1/", ("x", "A/n:1/"), "A/n:3/")
    above = paths(frame, "A/n:1/", "A/n:1/", "A/n:1/B/n:1/", "A/n:2/B/n:1/", "A/n:3/B/n:1/", ("y", "A/n:1/"))
    got = {r[fv.PATH]: (r.near, r.n) for r in ef.nearest_ancestors(rows, above, "near", "n").collect()}
    assert got == {
        "A/n:1/": ("A/n:1/", 1),
        "A/n:1/B/n:1/": ("A/n:1/B/n:1/", 2),
        "A/n:1/B/n:1/C/n:1/": ("A/n:1/B/n:1/", 2),
        "A/n:1/B/n:2/": ("A/n:1/", 1),
        "A/n:2/B/n:1/": ("A/n:2/B/n:1/", 1),
    }
    assert sorted(r[fv.PATH] for r in ef.descendants(rows, above).collect()) == sorted(got)
    assert ef.descendants(rows, above.limit(0)).collect() == ef.nearest_ancestors(rows.limit(0), above).collect() == []


def test_one_depth_and_any_depth_agree(frame):
    rows = paths(frame, *[f"A/n:{a}/B/n:{b}/" for a, b in itertools.product(range(4), range(3))])
    above = paths(frame, "A/n:1/", "A/n:3/")
    assert sorted(ef.descendants(rows, above, 1).collect()) == sorted(ef.descendants(rows, above).collect())


def test_any_depth_without_nested_loops(frame):
    plan = ef.nearest_ancestors(paths(frame, "A/n:1/"), paths(frame, "A/n:1/"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_ancestors_are_aggregated_by_hash_in_one_shuffle(frame):
    rows = paths(frame, "A/n:1/B/n:1/", "A/n:1/B/n:1/", "A/" * 70)
    above = paths(frame, "A/n:1/", "A/n:1/B/n:1/", "A/" * 70)
    found = ef.nearest_ancestors(rows, above, "near", "n")
    assert sorted((r.near, r.n) for r in found.collect()) == [("A/" * 70, 1)] + [("A/n:1/B/n:1/", 2)] * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1] if "Initial Plan" in plan else plan
    assert "SortAggregate" not in plan and "HashAggregate" in plan


# --- defaults per row ---


def counting():
    state = {"n": 0}

    def make():
        import uuid

        state["n"] += 1
        return f"made-{uuid.uuid4().hex}"

    return make


def defaulted(default, dtype=None):
    return ef.Schema("D", {"n": ef.Field(ef.Int64Type()), "mark": ef.Field(dtype or ef.StringType(), default=default)}, key=ef.key_policy("D", id_field="n"))


def test_each_missing_cell_has_a_value_of_its_own(store, frame):
    rows = frame([(n, "given" if n % 3 == 0 else None) for n in range(40)], "n int, mark string")
    schema = defaulted(ef.per_row(counting()))
    for options in ({}, {"skip_unchanged": True}):
        report = ef.write_entities(store, rows, schema, row_index="n", **options)
        report.raise_for_errors()
        stored = {r.n: r.mark for r in ef.read_entities(store, "D", schema=schema).collect()}
        made = [m for n, m in stored.items() if n % 3]
        assert all(m.startswith("made-") for m in made) and len(set(made)) == len(made) == 26
        assert all(m == "given" for n, m in stored.items() if n % 3 == 0)


def test_a_plan_keeps_what_was_made(store, frame):
    plan = ef.plan_entities(store, frame([(1, None), (2, None)], "n int, mark string"), defaulted(ef.per_row(counting())))
    first = [r.properties.mark for r in plan.df.orderBy("row_index").collect()]
    assert first == [r.properties.mark for r in plan.df.orderBy("row_index").collect()] and len(set(first)) == 2


def test_made_values_have_the_type_of_the_property_and_its_limit(store, frame):
    from datetime import datetime, timezone

    cases = [
        (ef.Int64Type(), lambda: 4, 4), (ef.Float64Type(), lambda: 0.5, 0.5), (ef.BoolType(), lambda: True, True),
        (ef.TimestampType(), lambda: datetime(2024, 1, 2, tzinfo=timezone.utc), None), (ef.KeyType(), lambda: ef.EntityKey((("K", "a"),)), None),
    ]
    for dtype, make, want in cases:
        plan = plan_rows(frame([(1,)], "n int"), defaulted(ef.per_row(make), dtype))
        row = plan.df.collect()[0]
        assert row.error is None and row.properties.mark is not None
        assert want is None or row.properties.mark == want
    long = plan_rows(frame([(1, None), (2, "x")], "n int, mark string"), defaulted(ef.per_row(lambda: "x" * 1501))).df.collect()
    assert [r.error is None for r in sorted(long, key=lambda r: r.row_index)] == [False, True]


def test_a_function_that_gives_the_same_is_as_a_literal(frame):
    rows = frame([(1, None), (2, "x")], "n int, mark string")
    one, other = (plan_rows(rows, defaulted(d), row_index="n").df.orderBy("row_index").collect() for d in (ef.per_row(lambda: "d"), "d"))
    assert one == other


# --- streams ---

LATEST = ef.Schema("L", {"at": ef.Field(ef.Int64Type()), "v": ef.Field(ef.Int64Type(), nullable=False)}, key=ef.key_policy("L", id_field="k"))


def test_the_latest_row_of_a_key_is_written(store, frame):
    rows = frame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("a", None, 5), ("b", None, 1), ("b", None, 2), ("c", 9, None), ("c", 1, 4), (None, 1, 1)], "k string, at int, v int")
    with pytest.raises(ef.KeyValidationError):
        ef.write_entities(store, rows.filter("k is not null"), LATEST)
    failed = []
    report = ef.write_entities(store, rows, LATEST, latest_by="at", reject=lambda bad: failed.extend(bad.collect()))
    assert (report.totals.rows, report.wrote, report.skipped, report.failed) == (9, 3, 4, 2)
    assert len(failed) == 2
    got = {r["__key__"]["path"][0]["name"]: (r.at, r.v) for r in ef.read_entities(store, "L", schema=LATEST, include_key=True).collect()}
    # Equal times go to the later row.
    assert got == {"a": (3, 30), "b": (None, 2), "c": (1, 4)}


def test_a_column_for_the_order_need_not_be_declared(store, frame):
    rows = frame([("a", 1, 1, 5), ("a", 1, 2, 7)], "k string, at int, v int, seq int")
    ef.write_entities(store, rows, LATEST, latest_by="seq").raise_for_errors()
    assert [r.v for r in ef.read_entities(store, "L", schema=LATEST).collect()] == [2]
    with pytest.raises(Exception, match="unknown fields"):
        ef.write_entities(store, rows.limit(1), LATEST).raise_for_errors()


def test_a_stream_goes_on_past_bad_rows(store, spark, frame, tmp_path):
    source = str(tmp_path / "in")
    frame([("a", 1, 1), ("a", 2, 2), (None, 3, 3)], "k string, at int, v int").coalesce(1).write.parquet(source)
    options = {"checkpoint": str(tmp_path / "check"), "latest_by": "at", "rejected": str(tmp_path / "bad")}

    def load():
        stream = spark.readStream.schema("k string, at int, v int").parquet(source)
        ef.start_upsert(stream, store, LATEST, **options).awaitTermination()

    load()
    frame([("a", 5, None), ("b", 4, 4)], "k string, at int, v int").coalesce(1).write.mode("append").parquet(source)
    load()
    got = {r["__key__"]["path"][0]["name"]: r.v for r in ef.read_entities(store, "L", schema=LATEST, include_key=True).collect()}
    assert got == {"a": 2, "b": 4}
    bad = ef.read_rejected(store, options["rejected"]).orderBy("batch").collect()
    assert [(r.batch, json.loads(r.row)) for r in bad] == [(0, {"at": 3, "v": 3}), (1, {"k": "a", "at": 5})]
    assert all(r.error for r in bad)


def test_a_later_batch_of_older_rows_replaces_nothing(store, spark, frame, tmp_path):
    source = tmp_path / "in"
    ddl = "k string, at int, v int"
    for name, rows in (("late", [("a", 9, 90), ("b", None, 1), ("c", 5, 50), ("d", 4, 40)]), ("early", [("a", 1, 10), ("a", 3, 30), ("b", 2, 20), ("c", None, 5), ("d", 4, 44)])):
        frame(rows, ddl).coalesce(1).write.parquet(str(source / name))
    # The newer rows are in the file that the stream takes first.
    for name, time in (("late", 1_000_000_000), ("early", 1_100_000_000)):
        for file in (source / name).glob("*.parquet"):
            os.utime(file, (time, time))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    ef.start_upsert(stream, store, LATEST, checkpoint=str(tmp_path / "check"), latest_by="at").awaitTermination()
    got = {r["__key__"]["path"][0]["name"]: (r.at, r.v) for r in ef.read_entities(store, "L", schema=LATEST, include_key=True).collect()}
    # Equal times go to the later batch.
    assert got == {"a": (9, 90), "b": (2, 20), "c": (5, 50), "d": (4, 44)}


def test_a_row_older_than_the_stored_one_is_reported_as_skipped(store, frame):
    ddl = "k string, at int, v int"
    ef.write_entities(store, frame([("a", 5, 1)], ddl), LATEST, latest_by="at").raise_for_errors()
    for skip in (False, True):
        report = ef.write_entities(store, frame([("a", 4, 2), ("a", 3, 3)], ddl), LATEST, latest_by="at", skip_unchanged=skip)
        assert (report.wrote, report.skipped) == (0, 2)
        assert {r.reason for r in report.results.collect()} == {"a later row of the same key is stored", "a later row of the same key is written"}
