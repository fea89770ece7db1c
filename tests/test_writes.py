import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import api, fixed_values as fv
from entityframe.plans.write_plan import may_repeat, require_unique_keys
from entityframe.sources import staging, store as stores

DOC = ef.Schema(
    "Doc",
    {"value": ef.Field(ef.Int64Type()), "kept": ef.Field(ef.StringType())},
    key=ef.key_policy("Doc", id_field="doc_id"),
)


@pytest.fixture
def docs(store):
    return ef.kind(schema=DOC, store=store)


@pytest.fixture
def two(docs, frame):
    docs.write(frame([("a", 1, "yes"), ("b", 1, "yes")], "doc_id string, value int, kept string"))
    return docs


def actions(df):
    return {r.row_index: r.action for r in df.collect()}


def stored(accessor):
    return {
        r[fv.PATH]: (r.value, r.kept, r[fv.PRESENT])
        for r in accessor.raw().select(fv.PATH, "value", "kept", fv.PRESENT).collect()
    }


def test_skip_unchanged_write(docs, frame):
    ddl = "doc_id string, value int"
    docs.write(frame([("a", 1), ("b", 1)], ddl))
    new = frame([("a", 1), ("b", 2), ("c", 3)], ddl)
    plan = docs.plan_write(new, skip_unchanged=True, row_index="doc_id")
    assert actions(plan.df) == {"a": "skip", "b": "update", "c": "create"}
    assert not plan.has_errors
    report = docs.write(new, skip_unchanged=True, row_index="doc_id")
    assert (report.wrote, report.skipped, report.planned_writes, report.failed) == (2, 1, 2, 0)
    assert {p: v[0] for p, v in stored(docs).items()} == {"Doc/n:a/": 1, "Doc/n:b/": 2, "Doc/n:c/": 3}
    again = docs.write(new, skip_unchanged=True)
    assert (again.wrote, again.skipped) == (0, 3)


def test_extra_stored_property_counts_as_change(two, frame):
    plan = two.plan_write(frame([("a", 1)], "doc_id string, value int"), skip_unchanged=True, row_index="doc_id")
    assert actions(plan.df) == {"a": "update"}


def test_skip_unchanged_patch(two, frame):
    new = frame([("a", 1), ("b", 2)], "doc_id string, value int")
    report = two.patch(new, properties=["value"], skip_unchanged=True, row_index="doc_id")
    assert actions(report.results) == {"a": "skip", "b": "patch"}
    assert stored(two)["Doc/n:b/"] == (2, "yes", ["kept", "value"])


def test_patch_treats_absent_as_null_but_full_writes_do_not(docs, frame):
    schema = ef.Schema("Doc", {**DOC.properties, "kept": ef.Field(ef.StringType(), missing_policy="null")}, key=DOC.key)
    docs.write(frame([("a", 1)], "doc_id string, value int"))
    nulls = ef.kind(schema=schema, store=docs.store)
    df = frame([("a", 1, None)], "doc_id string, value int, kept string")
    patch = nulls.plan_write(df, patch=True, properties=["kept"], skip_unchanged=True, row_index="doc_id")
    assert actions(patch.df) == {"a": "skip"}
    full = nulls.plan_write(df, skip_unchanged=True, row_index="doc_id")
    assert actions(full.df) == {"a": "update"}


def test_patch_of_missing_entity_creates_only_the_patched_names(two, frame):  # T15
    report = two.patch(frame([("c", 5)], "doc_id string, value int"), properties=["value"])
    assert report.wrote == 1
    assert stored(two)["Doc/n:c/"] == (5, None, ["value"])


def test_patch_skips_required_checks(docs, frame):  # T15
    schema = ef.Schema("Doc", {"value": ef.Field(ef.Int64Type()), "kept": ef.Field(ef.StringType(), nullable=False)}, key=DOC.key)
    strict = ef.kind(schema=schema, store=docs.store)
    df = frame([("a", 5)], "doc_id string, value int")
    assert strict.patch(df, properties=["value"]).wrote == 1
    assert strict.write(df).failed == 1


def test_empty_patch(two, frame):  # T16
    df = frame([("a", None), ("z", None)], "doc_id string, value int")
    plan = two.plan_write(df, patch=True, properties=["value"], skip_unchanged=True, row_index="doc_id")
    assert actions(plan.df) == {"a": "skip", "z": "create"}
    report = two.patch(df, properties=["value"], row_index="doc_id")
    assert actions(report.results) == {"a": "skip", "z": "patch"}
    assert stored(two)["Doc/n:z/"] == (None, None, [])


def test_patch_needs_a_list_of_properties(two, frame):
    with pytest.raises(ef.SchemaError):
        two.plan_write(frame([("a", 1)], "doc_id string, value int"), patch=True)


def test_patch_merges_unindexed_names(docs, frame):
    first = ef.kind(schema=ef.Schema("Doc", {"value": ef.Field(ef.Int64Type(), indexed=False)}, key=DOC.key), store=docs.store)
    second = ef.kind(schema=ef.Schema("Doc", {"kept": ef.Field(ef.StringType(), indexed=False)}, key=DOC.key), store=docs.store)
    first.write(frame([("a", 1)], "doc_id string, value int"))
    second.patch(frame([("a", "x")], "doc_id string, kept string"), properties=["kept"])
    assert docs.raw().first()[fv.UNINDEXED] == ["kept", "value"]


def test_insert_and_update(two, frame):
    df = frame([("a", 9), ("c", 9)], "doc_id string, value int")
    report = two.write(df, mode="insert", row_index="doc_id")
    assert {r.row_index: r.error for r in report.results.collect()} == {"a": fv.ERROR_INSERT_TARGET, "c": None}
    assert report.wrote == 1  # T12: an insert is a write
    assert stored(two)["Doc/n:a/"][0] == 1 and stored(two)["Doc/n:c/"][0] == 9
    report = two.write(frame([("a", 7), ("q", 7)], "doc_id string, value int"), mode="update", row_index="doc_id")
    assert {r.row_index: r.error for r in report.results.collect()} == {"a": None, "q": fv.ERROR_UPDATE_TARGET}
    assert stored(two)["Doc/n:a/"] == (7, None, ["value"]) and "Doc/n:q/" not in stored(two)
    with pytest.raises(ef.SchemaError):
        two.write(df, mode="replace")


def test_insert_dry_run_counts_planned_writes(docs, frame):  # T12
    df = frame([("a", 1)], "doc_id string, value int")
    assert docs.write(df, mode="insert", dry_run=True).planned_writes == 1
    assert docs.write(df, mode="insert", read_only=True).failed == 1


def test_dry_run_and_read_only_write_nothing(two, frame):
    df = frame([("a", 5), ("c", 5)], "doc_id string, value int")
    dry = two.write(df, dry_run=True)
    assert (dry.wrote, dry.would_write, dry.succeeded) == (0, 2, 2)
    blocked = two.with_scope(read_only=True).write(df)
    assert blocked.failed == 2
    assert {r.error for r in blocked.results.collect()} == {fv.ERROR_READ_ONLY}
    assert stored(two)["Doc/n:a/"][0] == 1 and len(stored(two)) == 2
    with pytest.raises(ef.WriteFailedError, match="2 write"):
        blocked.raise_for_errors()


def test_full_write_replaces_the_entity(two, frame):
    two.write(frame([("a", 5)], "doc_id string, value int"))
    assert stored(two)["Doc/n:a/"] == (5, None, ["value"])


def test_repeated_keys_raise(two, frame):  # T13
    df = frame([("a", 5), ("a", 6)], "doc_id string, value int")
    for options in ({}, {"dry_run": True}, {"skip_unchanged": True}, {"mode": "update"}):
        with pytest.raises(ef.KeyValidationError):
            two.write(df, **options)
    with pytest.raises(ef.KeyValidationError):
        two.plan_write(df)
    with pytest.raises(ef.KeyValidationError):
        two.patch(df, properties=["value"])
    assert stored(two)["Doc/n:a/"][0] == 1


def test_repeated_keys_raise_when_a_row_would_be_skipped_or_fail(two, frame):  # T13
    df = frame([("a", 1, "yes"), ("a", 2, "yes")], "doc_id string, value int, kept string")
    with pytest.raises(ef.KeyValidationError):
        two.write(df, skip_unchanged=True)
    with pytest.raises(ef.KeyValidationError):
        two.write(df, mode="insert")
    bad = frame([("q", "1"), ("q", "x")], "doc_id string, value string")
    with pytest.raises(ef.KeyValidationError):
        two.write(bad)
    assert "Doc/n:q/" not in stored(two)


def test_uniqueness_of_plans_looks_at_the_whole_key(docs, frame):  # T11
    df = frame(
        ['{"path":[{"kind":"Doc","name":"a"}]}', '{"project":"p","path":[{"kind":"Doc","name":"a"}]}'], f"{fv.KEY} string"
    )
    assert docs.plan_write(df).df.count() == 2
    with pytest.raises(ef.KeyValidationError):
        docs.write(df)


def test_key_errors_raise_in_writes_and_are_rows_in_plans(docs, frame):  # T14
    df = frame([("a", "1"), (None, "2"), ("c", "x")], "doc_id string, value string")
    plan = docs.plan_write(df, row_index="value")
    assert actions(plan.df) == {"1": "upsert", "2": "error", "x": "error"}
    with pytest.raises(ef.KeyValidationError):
        docs.write(df)
    report = docs.write(df.filter("doc_id is not null"), row_index="doc_id")
    assert (report.wrote, report.failed) == (1, 1)
    assert report.failures().first().row_index == "c"


def test_incomplete_keys(docs, frame):  # T13
    schema = ef.Schema("Doc", {"value": ef.Field(ef.Int64Type())}, key=ef.KeySpec([("Doc", ef.KeyPart("no", kind="auto"))]))
    auto = ef.kind(schema=schema, store=docs.store)
    df = frame([(1,), (2,)], "value int")
    assert set(actions(auto.plan_write(df, row_index="value").df).values()) == {"error"}
    with pytest.raises(ef.SchemaError, match="2 row"):
        auto.write(df)


def test_reports_merge(two, frame):
    df = frame([("a", 1)], "doc_id string, value int")
    both = two.write(df, dry_run=True).extend(two.write(df, read_only=True))
    assert (both.totals.rows, both.succeeded, both.failed, both.planned_writes) == (2, 1, 1, 2)


def test_direct_writes_have_no_plan(docs, frame):
    report = docs.write(frame([("a", 1)], "doc_id string, value int"))
    assert (report.planned_writes, report.wrote) == (0, 1)


def test_mixed_values_compare_by_content(store, frame):
    schema = ef.Schema("Doc", {"o": ef.Field(ef.ObjectType()), "k": ef.Field(ef.KeyType()), "t": ef.Field(ef.ArrayType(ef.StringType()))}, key=DOC.key)
    accessor = ef.kind(schema=schema, store=store)
    ddl = "doc_id string, o string, k string, t array<string>"
    key = '{"project":%s,"path":[{"kind":"U","id":1}]}'
    first = frame([("a", '{"x":1,"y":[2]}', key % "null", ["p"]), ("b", "1", key % "null", [])], ddl)
    accessor.write(first.withColumn("o", F.parse_json("o")))
    # Same object with its names turned round; keys compare by namespace and path.
    second = frame([("a", '{"y":[2],"x":1}', key % '"p"', ["p"]), ("b", '"1"', key % "null", [])], ddl)
    plan = accessor.plan_write(second.withColumn("o", F.parse_json("o")), skip_unchanged=True, row_index="doc_id")
    assert actions(plan.df) == {"a": "skip", "b": "update"}


def test_timestamps_compare_as_instants(store, frame):
    schema = ef.Schema("Doc", {"at": ef.Field(ef.TimestampType())}, key=DOC.key)
    accessor = ef.kind(schema=schema, store=store)
    accessor.write(frame([("a", "2026-01-01T00:00:00Z")], "doc_id string, at string"))
    plan = accessor.plan_write(frame([("a", "2026-01-01T02:00:00+02:00")], "doc_id string, at string"), skip_unchanged=True, row_index="doc_id")
    assert actions(plan.df) == {"a": "skip"}


def test_round_trip(store, frame):
    schema = ef.Schema(
        "Doc",
        {
            "i": ef.Field(ef.Int64Type()), "f": ef.Field(ef.Float64Type()), "b": ef.Field(ef.BoolType()),
            "s": ef.Field(ef.StringType()), "x": ef.Field(ef.BlobType()), "t": ef.Field(ef.TimestampType()),
            "g": ef.Field(ef.GeoPointType()), "a": ef.Field(ef.ArrayType(ef.Int64Type())), "e": ef.Field(ef.EmbeddedEntityType()),
        },
        key=ef.key_policy("Doc", id_field="s"),
    )
    accessor = ef.kind(schema=schema, store=store)
    df = frame(
        [(1, 1.5, True, "s", bytearray(b"b"), "2026-01-01 00:00:00.123456", [1.0, 2.0], [1, 2], (1,)), (None, None, None, "n", None, None, None, None, None)],
        "i int, f double, b boolean, s string, x binary, t string, g array<double>, a array<int>, e struct<z:int>",
    )
    accessor.write(df).raise_for_errors()
    read = accessor.read()
    assert read.columns == list(schema.properties)
    row = read.filter("s = 's'").first()
    assert (row.i, row.f, row.b, bytes(row.x), tuple(row.g), row.a) == (1, 1.5, True, b"b", (1.0, 2.0), [1, 2])
    assert row.e.toPython() == {"z": 1} and row.t.microsecond == 123456
    plan = accessor.plan_write(read, skip_unchanged=True, row_index="s")
    assert actions(plan.df) == {"s": "skip", "n": "skip"}


def test_a_row_that_is_not_written_leaves_its_values_out_of_the_judged_table(two, frame, monkeypatch):
    staged, stage = {}, api.stage
    monkeypatch.setattr(api, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    report = two.write(frame([("a", 1, "yes"), ("b", 2, "no"), ("c", 3, "new")], "doc_id string, value int, kept string"), skip_unchanged=True, row_index="doc_id")
    held = {r.row_index: (r.properties is not None, r[fv.PATH] is not None) for r in staged["judged"].collect()}
    assert held == {"a": (False, False), "b": (True, True), "c": (True, True)}
    assert {r.row_index: (r.action, r[fv.KEY] is not None) for r in report.results.collect()} == {"a": ("skip", True), "b": ("upsert", True), "c": ("upsert", True)}
    assert {p: v[0] for p, v in stored(two).items()} == {"Doc/n:a/": 1, "Doc/n:b/": 2, "Doc/n:c/": 3}


def test_keys_are_grouped_as_texts_only_where_a_hash_repeats(frame):
    ddl = "__key__ struct<database:string,namespace:string,path:array<struct<id:bigint,kind:string,name:string>>,project:string>"

    def rows(*keys):
        plain = frame([((base, None, [(None, "Doc", name)], project),) for base, name, project in keys], ddl)
        return plain.withColumns({fv.NS: F.lit("@"), fv.PATH: F.concat(F.lit("Doc/n:"), F.col(fv.KEY)["path"][0]["name"], F.lit("/"))})

    assert not may_repeat(rows((None, "a", None), (None, "b", None)))
    assert not may_repeat(rows(("x", "a", None), ("y", "a", None)))
    # A null is passed over by the hash, so these meet in it; the keys themselves decide.
    alike = rows(("x", "a", None), (None, "a", "x"))
    assert may_repeat(alike)
    require_unique_keys(alike)
    with pytest.raises(ef.KeyValidationError):
        require_unique_keys(alike, full_key=False)
    with pytest.raises(ef.KeyValidationError):
        require_unique_keys(rows(("x", "a", None), ("x", "a", None)))


def test_a_merge_reads_its_tables_in_small_pieces(spark, two, frame, monkeypatch):
    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    two.write(frame([("c", 3, "new")], "doc_id string, value int, kept string"))
    with staging.small_splits(spark):
        assert int(spark.conf.get(name)) == staging.SPLIT_BYTES
        spark.conf.set(name, "1m")
        with staging.small_splits(spark):
            assert spark.conf.get(name) == "1m"
    assert spark.conf.get(name) == before

    split = stores.small_splits

    def entered(session):
        seen.append(session.conf.get(name))
        return split(session)

    monkeypatch.setattr(stores, "small_splits", entered)
    two.delete([ef.EntityKey((("Doc", "a"),))])
    assert seen == [before] and spark.conf.get(name) == before
    assert set(stored(two)) == {"Doc/n:b/", "Doc/n:c/"}
