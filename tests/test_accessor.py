from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv

NOW = datetime(2026, 1, 2, tzinfo=timezone.utc)
WORKOUT = ef.Schema(
    "Workout",
    {"value": ef.Field(ef.Int64Type()), "kind": ef.Field(ef.StringType())},
    key=ef.key_policy("Workout", id_field="w", namespace_field="tenant", ancestors=[("User", "user")]),
)
DDL = "tenant string, user string, w string, value int, kind string"
ROWS = [("t", "a", "1", 1, "run"), ("t", "a", "2", 2, "bike"), ("t", "b", "3", 3, "run"), ("s", "a", "4", 4, "run")]


@pytest.fixture
def workouts(store, frame):
    accessor = ef.kind(schema=WORKOUT, store=store)
    accessor.write(frame(ROWS, DDL)).raise_for_errors()
    return accessor


def values(df):
    return sorted(r.value for r in df.collect())


def test_bound_filters_add_up_and_the_rest_replaces(workouts):  # T22
    bound = workouts.with_scope(filters=[("kind", "=", "run")])
    assert values(bound.read()) == [1, 3, 4]
    assert values(bound.read(filters=[("value", ">", 1)])) == [3, 4]
    ordered = ef.kind(schema=WORKOUT, store=workouts.store, order=["value"], projection=["kind"])
    assert ordered.read().columns == ["kind"]
    assert [r.value for r in ordered.read(order=["-value"], projection=["value"]).collect()] == [4, 3, 2, 1]


def test_ancestor_namespace_wins(workouts):  # T21
    ancestor = ef.EntityKey((("User", "a"),), namespace="t")
    assert values(workouts.read(ancestor=ancestor, namespace="s")) == [1, 2]
    assert values(workouts.with_ancestor(ancestor).read(namespace="s")) == [1, 2]
    assert values(workouts.with_scope(namespace="s").read()) == [4]
    assert values(workouts.with_scope(namespace="s").read(namespace="t")) == [1, 2, 3]


def test_none_keeps_the_bound_value(workouts):  # T23
    bound = workouts.with_scope(namespace="s", read_only=True)
    again = bound.with_scope(namespace=None, read_only=None)
    assert again.namespace == "s" and again.read_only is True
    assert bound.with_scope(read_only=False).read_only is False


def test_writes_stay_under_the_ancestor(workouts, frame):
    ancestor = ef.EntityKey((("User", "a"),), namespace="t")
    scoped = workouts.with_ancestor(ancestor)
    scoped.write(frame([("t", "a", "9", 9, None)], DDL)).raise_for_errors()
    for bad in (("t", "ab", "9", 9, None), ("s", "a", "9", 9, None)):
        df = frame([bad], DDL)
        for attempt in (scoped.plan_write, scoped.write, lambda d: scoped.patch(d, properties=["value"])):
            with pytest.raises(ef.SchemaError):
                attempt(df)
    assert values(workouts.read()) == [1, 2, 3, 4, 9]
    free = ef.kind(schema=WORKOUT, store=workouts.store, ancestor=ancestor, enforce_ancestor=False)
    assert free.write(frame([("t", "ab", "9", 10, None)], DDL)).wrote == 1


def test_call_time_read_only_overrides(workouts, frame):
    df = frame([("t", "a", "1", 5, "run")], DDL)
    bound = workouts.with_scope(read_only=True)
    assert bound.write(df).failed == 1
    assert bound.write(df, read_only=False).wrote == 1
    assert workouts.patch(df, properties=["value"], read_only=True).failed == 1


def test_count_and_keys(workouts):
    assert workouts.count() == 4
    assert workouts.count(filters=[("kind", "=", "run")]) == 3
    assert workouts.read(keys_only=True).columns == [fv.KEY]
    assert workouts.read(include_key=True).columns == ["value", "kind", fv.KEY]


def test_audit_modes(frame):
    df = frame([("a", None), ("b", NOW.replace(tzinfo=None))], "doc_id string, created timestamp_ntz")
    df = df.withColumn("created", F.col("created").cast("timestamp")).withColumn("modified", F.col("created"))
    policy = ef.AuditPolicy(
        created="created", modified="modified", updated_at="updated", imported_at="batch",
        set_imported_at="never", now=lambda: datetime(2030, 1, 1, tzinfo=timezone.utc),
    )
    made = policy.apply(df)
    assert made.columns == ["doc_id", "created", "modified", "updated"]
    rows = {r.doc_id: (r.c, r.m, r.u) for r in made.select("doc_id", F.year("created").alias("c"), F.year("modified").alias("m"), F.year("updated").alias("u")).collect()}
    assert rows == {"a": (2030, 2030, 2030), "b": (2026, 2030, 2030)}
    assert ef.AuditPolicy().apply(df) is df
    with pytest.raises(ef.SchemaError):
        ef.AuditPolicy(created="c", set_created="sometimes")


def test_moving_stamps_make_every_row_changed(store, frame):  # T28
    schema = ef.Schema("Doc", {"v": ef.Field(ef.Int64Type()), "modified": ef.Field(ef.TimestampType())}, key=ef.key_policy("Doc", id_field="d"))
    fixed = ef.kind(schema=schema, store=store, audit=ef.AuditPolicy(modified="modified", now=lambda: NOW))
    df = frame([("a", 1)], "d string, v int")
    assert fixed.write(df).wrote == 1
    assert fixed.write(df, skip_unchanged=True).skipped == 1
    assert fixed.with_scope(audit=ef.AuditPolicy(modified="modified")).write(df, skip_unchanged=True).wrote == 1


DEDUP = ef.Schema(
    "Doc", {"external": ef.Field(ef.StringType()), "updated": ef.Field(ef.Int64Type())}, key=ef.key_policy("Doc", id_field="d")
)


@pytest.fixture
def doubles(store, frame):
    accessor = ef.kind(schema=DEDUP, store=store)
    rows = [("old", "x", 1), ("new", "x", 2), ("none", "x", None), ("solo", "y", 1), ("n1", None, 1), ("n2", None, 1)]
    accessor.write(frame(rows, "d string, external string, updated int")).raise_for_errors()
    return accessor


def dropped(plan):
    return sorted(r[fv.PATH].split(":")[1].rstrip("/") for r in plan.df.collect())


def test_duplicates_order_and_nulls(doubles):  # T18
    plan = doubles.plan_duplicate_cleanup(by=["external"], order=["updated"])
    assert dropped(plan) == ["n2", "new", "none"]
    plan = doubles.plan_duplicate_cleanup(by=["external"], order=["-updated"])  # NULL first
    assert dropped(plan) == ["n2", "new", "old"]
    plan = doubles.plan_duplicate_cleanup(by=["external"], order=["updated"], keep="last")
    assert dropped(plan) == ["n1", "new", "old"]
    plan = doubles.plan_duplicate_cleanup(by=["external"], order=["-updated"], filters=[("updated", ">", 0)])
    assert dropped(plan) == ["n2", "old"]
    assert 'duplicate group {"external":"x"}' in {r.reason for r in plan.df.collect()}


def test_cleanup_runs_dry_by_default(doubles):
    report = doubles.cleanup_duplicates(by=["external"], order=["updated"])
    assert (report.planned_writes, report.wrote, report.dry_run) == (3, 0, True)
    blocked = doubles.with_scope(read_only=True).cleanup_duplicates(by=["external"], dry_run=False)
    assert blocked.failed == 3 and doubles.count() == 6
    done = doubles.cleanup_duplicates(by=["external"], order=["updated"], dry_run=False)
    assert done.wrote == 3 and doubles.count() == 3


def test_duplicate_requests_are_checked(doubles, frame):
    with pytest.raises(ef.SchemaError):
        doubles.plan_duplicate_cleanup(by=[])
    with pytest.raises(ef.SchemaError):
        doubles.plan_duplicate_cleanup(by=["external"], keep="middle")
    with pytest.raises(ef.SchemaError):
        doubles.plan_duplicate_cleanup(by=["external"], frame=frame(["x"], "external string"))


def test_nan_rows_match_nothing(frame):  # T18
    df = frame([(1, float("nan")), (2, float("nan")), (3, 1.0), (4, 1.0), (5, None), (6, None)], "id int, x double")
    assert sorted(r.id for r in ef.survivors(df, ["x"], tie=["id"]).collect()) == [1, 2, 3, 5]
    assert sorted(r.id for r in ef.surplus(df, ["x"], tie=["id"]).collect()) == [4, 6]


def test_grouping_by_arrays_and_keys(frame):  # T19
    df = frame([(1, [1, 2]), (2, [1, 2]), (3, [2, 1])], "id int, a array<int>")
    assert sorted(r.id for r in ef.survivors(df, ["a"], tie=["id"]).collect()) == [1, 3]


def test_dedup_matches_brute_force_with_a_hot_group(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"), (F.col("id") * 7919 % 101).alias("o")
    )
    kept = {r.id for r in ef.survivors(df, ["g"], order=["-o"], tie=["id"]).collect()}
    best = {}
    for r in df.collect():
        if r.g not in best or (-r.o, r.id) < best[r.g]:
            best[r.g] = (-r.o, r.id)
    assert kept == {i for _, i in best.values()}
    assert ef.surplus(df, ["g"], order=["-o"], tie=["id"]).count() == 3000 - len(best)


def test_duplicates_group_by_digest_not_by_text(frame):
    df = frame(
        [(1, None, [None, 1]), (2, None, [1, None]), (3, "", [1]), (4, None, [None, 1]), (5, "t" * 5000, None), (6, "t" * 5000, None)],
        "id int, x string, y array<int>",
    )
    made = ef.surplus(df, ["x", "y"], tie=["id"])
    assert sorted(r.id for r in made.collect()) == [4, 6]
    plan = ef.surplus(df.select("id", "x"), ["x"], tie=["id"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Window" in plan and "x#" not in window.split("\n")[0].split("specifiedwindow")[-1]


def test_cleanup_needs_keys_of_their_own(store, frame):
    schema = ef.Schema("D", {"x": ef.Field(ef.StringType())}, key=ef.key_policy("D", id_field="d"))
    ef.write_entities(store, frame([("a", "v"), ("b", "v")], "d string, x string"), schema)
    accessor = ef.kind(schema=schema, store=store)
    rows = accessor.raw()
    with pytest.raises(ef.KeyValidationError):
        accessor.plan_duplicate_cleanup(by=["x"], frame=rows.unionByName(rows))
    assert accessor.plan_duplicate_cleanup(by=["x"]).df.count() == 1


def test_delete_keeps_to_scope_and_read_only(store, frame):
    schema = ef.Schema("M", {"v": ef.Field(ef.Int64Type())}, key=ef.key_policy("M", id_field="n", ancestors=[("X", "x")]))
    ef.write_entities(store, frame([("a", "1", 1), ("b", "1", 2)], "x string, n string, v int"), schema)
    accessor = ef.kind(schema=schema, store=store)
    mine, other = (ef.EntityKey((("X", x), ("M", "1"))) for x in "ab")
    closed = accessor.with_scope(read_only=True).delete([mine])
    assert (closed.failed, closed.wrote, accessor.count()) == (1, 0, 2)
    bound = accessor.with_ancestor(ef.EntityKey((("X", "a"),)))
    mixed = bound.delete([mine, other])
    assert (mixed.failed, mixed.wrote, accessor.count()) == (1, 0, 2)
    assert bound.delete([mine]).wrote == 1 and accessor.count() == 1
    assert accessor.delete([other], dry_run=True).wrote == 0 and accessor.count() == 1


def test_a_page_follows_a_bound_order(store, frame):
    schema = ef.Schema("N", {"v": ef.Field(ef.Int64Type())}, key=ef.key_policy("N", id_field="n"))
    ef.write_entities(store, frame([(n, n % 3) for n in range(8)], "n int, v int"), schema)
    accessor = ef.kind(schema=schema, store=store, order=["-v"])
    first = accessor.page(5)
    assert [r.v for r in first.rows.collect()] == [2, 2, 1, 1, 1]
    assert [r.v for r in accessor.page(5, after=first.next).rows.collect()] == [0, 0, 0]
    with pytest.raises(ef.QueryValidationError):
        accessor.with_order("v").page(5, after=first.next)
    chunks = [c.columns for c in ef.kind(schema=schema, store=store).iter(keys_only=True)]
    assert chunks == [[fv.KEY]]
