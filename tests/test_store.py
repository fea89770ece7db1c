import tempfile

import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv

DOC = ef.Schema(
    "Doc", {"value": ef.Field(ef.Int64Type())}, key=ef.key_policy("Doc", id_field="doc_id", namespace_field="ns")
)
DDL = "ns string, doc_id string, value int"


@pytest.fixture
def table(spark, frame):
    return make_table(spark, frame, True)


@pytest.fixture
def flat_table(spark, frame):
    return make_table(spark, frame, False)


def make_table(spark, frame, by_namespace):
    store = ef.EntityStore(spark, tempfile.mkdtemp(prefix="entities-"), buckets=3, by_namespace=by_namespace)
    rows = [(ns, f"d{n}", n) for ns in ("x", "y", None) for n in range(20)]
    ef.write_entities(store, frame(rows, DDL), DOC)
    return store.table("Doc")


def values(df):
    return {(r[fv.NS], r[fv.PATH]): r.value for r in df.collect()}


def test_reads_what_was_written(table):
    assert len(values(table.read())) == 60
    assert values(table.read())[("@", "Doc/n:d3/")] == 3


def test_without_namespace_folders(flat_table, frame):
    table = flat_table
    before = table.snapshot()
    ef.write_entities(table.store, frame([("x", "d1", 100)], DDL), DOC)
    assert len(table.snapshot().partitions - before.partitions) == 1
    got = values(table.read())
    assert len(got) == 60 and got[("x", "Doc/n:d1/")] == 100
    ef.delete_entities(table.store, "Doc", [ef.EntityKey((("Doc", "d1"),), namespace="x")])
    table.clear("y")
    got = values(table.read())
    assert len(got) == 39 and {ns for ns, _ in got} == {"x", "@"}
    assert values(table.get([ef.EntityKey((("Doc", "d2"),))])) == {("@", "Doc/n:d2/"): 2}
    assert ef.read_entities(table.store, "Doc", schema=DOC, namespace="x").count() == 19


def test_missing_kind_reads_empty(store):
    empty = ef.read_entities(store, "Nothing", schema=DOC, include_key=True)
    assert empty.columns == ["value", fv.KEY] and empty.count() == 0
    assert not store.table("Nothing").exists()
    assert store.table("Nothing").get([ef.EntityKey((("A", 1),))]) is None


def test_a_commit_rewrites_only_its_partitions(table, frame):
    before = table.snapshot()
    ef.write_entities(table.store, frame([("x", "d1", 100)], DDL), DOC)
    after = table.snapshot()
    assert after.version == before.version + 1
    assert len(after.partitions - before.partitions) == 1
    assert len(after.partitions) == len(before.partitions)
    got = values(table.read())
    assert len(got) == 60 and got[("x", "Doc/n:d1/")] == 100


def test_readers_keep_their_version(table, frame):
    old = table.snapshot()
    before = table.read(old)
    ef.write_entities(table.store, frame([("x", "d1", 100)], DDL), DOC)
    table.clear(all_namespaces=True)
    assert len(values(before)) == 60
    assert len(values(table.read(table.snapshot(1)))) == 60
    assert table.read().count() == 0
    with pytest.raises(ef.SchemaError):
        table.snapshot(99)


def test_delete_keys(table):
    keys = [ef.EntityKey((("Doc", f"d{n}"),), namespace="x") for n in range(20)] + [ef.EntityKey((("Doc", "zz"),))]
    ef.delete_entities(table.store, "Doc", keys)
    got = values(table.read())
    assert len(got) == 40 and not [k for k in got if k[0] == "x"]


def test_clear_namespace(table):
    table.clear(None)
    assert {ns for ns, _ in values(table.read())} == {"x", "y"}
    table.clear("x")
    assert {ns for ns, _ in values(table.read())} == {"y"}


def test_bulk_get(table):
    keys = [ef.EntityKey((("Doc", "d5"),), namespace="y"), ef.EntityKey((("Doc", "none"),))]
    assert values(table.get(keys)) == {("y", "Doc/n:d5/"): 5}


def scanned_rows(df):
    """Rows that the scans of a collected frame have handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan

    def scans(node):
        if "Scan parquet" in node.nodeName():
            return [node]
        inner = node.plan() if hasattr(node, "plan") and "QueryStage" in node.nodeName() else None
        children = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
        return [s for c in children for s in scans(c)]

    return sum(s.metrics().apply("numOutputRows").value() for s in scans(plan))


@pytest.mark.parametrize("as_frame", [False, True])
def test_few_keys_skip_row_groups(spark, frame, tmp_path, as_frame):
    store = ef.EntityStore(spark, str(tmp_path), buckets=1, row_group_bytes=16 << 10)
    rows = spark.range(30_000).selectExpr("'x' ns", "format_string('d%06d', id) doc_id", "id value")
    ef.write_entities(store, rows, DOC)
    table = store.table("Doc")
    wanted = [f"d{n:06d}" for n in [*range(7_000, 7_050), *range(21_000, 21_049), 29_999]]
    keys = [ef.EntityKey((("Doc", d),), namespace="x") for d in [*wanted, "d7", "none"]]
    asked = spark.createDataFrame([(k.ns_code, k.path_text) for k in keys], f"{fv.NS} string, {fv.PATH} string") if as_frame else keys
    got = table.get(asked)
    assert sorted(r.value for r in got.select("value").collect()) == [int(d[1:]) for d in wanted]
    found = table.get(asked).select("value")
    found.collect()
    assert 100 <= scanned_rows(found) < 10_000
    many = [ef.EntityKey((("Doc", f"d{n:06d}"),), namespace="x") for n in range(600)]
    assert table.get(many).count() == 600 and table.get([]).count() == 0
    other = [ef.EntityKey((("Doc", "d000001"),), namespace="y")]
    assert table.get(other).count() == 0


# --- ranges of keys as partitions ---

DAY = ef.Schema("Day", {"value": ef.Field(ef.Int64Type())}, key=ef.key_policy("Day", id_field="at", ancestors=[("City", "city")]))
DAY_DDL = "city string, at string, value int"


def day(city, at):
    return ef.EntityKey((("City", city), ("Day", at)))


@pytest.fixture
def ranged(spark, frame, tmp_path):
    cuts = [ef.EntityKey((("City", "b"),)), day("b", "2024-02"), ef.EntityKey((("City", "é"),)), day("b", "2024-02")]
    store = ef.EntityStore(spark, str(tmp_path), ranges=cuts, by_namespace=False)
    rows = [(c, f"2024-0{m}-{d:02d}", m) for c in ("a", "b", "c", "é", "😀") for m in (1, 2, 3) for d in (1, 2)]
    ef.write_entities(store, frame(rows, DAY_DDL), DAY).raise_for_errors()
    return store.table("Day")


def test_a_batch_of_one_range_rewrites_only_that_range(ranged, frame):
    before = ranged.snapshot()
    assert len(before.partitions) == 4
    ef.write_entities(ranged.store, frame([("b", f"2024-01-{d:02d}", 9) for d in range(1, 29)], DAY_DDL), DAY).raise_for_errors()
    after = ranged.snapshot()
    assert {(ns, b) for ns, b, _ in after.partitions - before.partitions} == {(None, 1)}
    assert ranged.read().count() == 56 and ranged.read().filter("value = 9").count() == 28
    ef.patch_entities(ranged.store, frame([("é", "2024-01-01", 8)], DAY_DDL), DAY, properties=["value"]).raise_for_errors()
    assert {(ns, b) for ns, b, _ in ranged.snapshot().partitions - after.partitions} == {(None, 3)}
    ef.delete_entities(ranged.store, "Day", [day("a", "2024-01-01")])
    assert [tuple(r) for r in ranged.get([day("é", "2024-01-01"), day("a", "2024-01-01")]).select("value").collect()] == [(8,)]


def test_every_row_lies_in_its_range(ranged):
    cuts = [c.encode() for c in ranged.snapshot().buckets]
    assert cuts == sorted(cuts) and len(cuts) == 3
    for r in ranged.read().collect():
        assert r[fv.BUCKET] == sum(c <= r[fv.PATH].encode() for c in cuts)


def test_a_scan_of_an_ancestor_opens_only_its_ranges(ranged):
    for city, buckets in (("a", {0}), ("b", {1, 2}), ("c", {2}), ("é", {3}), ("😀", {3})):
        scope = ef.EntityKey((("City", city),))
        assert {r[fv.BUCKET] for r in ranged.read_under(scope).select(fv.BUCKET).distinct().collect()} == buckets
        assert ef.read_entities(ranged.store, "Day", schema=DAY, ancestor=scope).count() == 6
    assert ef.read_entities(ranged.store, "Day", schema=DAY, ancestor=ef.EntityKey((("City", "0"),))).count() == 0


def test_even_ranges_and_the_layout_a_kind_began_with(spark, frame, tmp_path):
    rows = frame([("a", f"d{n:03d}", n) for n in range(400)] + [("b", None, 1)], DAY_DDL)
    cuts = ef.choose_ranges(rows, DAY, 4)
    store = ef.EntityStore(spark, str(tmp_path), ranges=cuts)
    ef.write_entities(store, rows.filter("at is not null"), DAY).raise_for_errors()
    sizes = [r["count"] for r in store.table("Day").read().groupBy(fv.BUCKET).count().collect()]
    assert len(sizes) == 4 and max(sizes) == 100
    hashed = ef.EntityStore(spark, str(tmp_path), buckets=2)
    ef.write_entities(hashed, frame([("a", "d000", 7)], DAY_DDL), DAY).raise_for_errors()
    assert hashed.table("Day").read().count() == 400 and hashed.table("Day").snapshot().buckets == tuple(cuts)
    assert ef.choose_ranges(rows.limit(0), DAY, 4) == []


def test_layout_is_kept(spark, table, frame):
    other = ef.EntityStore(spark, table.store.root, buckets=9, by_namespace=not table.store.by_namespace)
    ef.write_entities(other, frame([("x", "d1", 7)], DDL), DOC)
    got = values(other.table("Doc").read())
    assert len(got) == 60 and got[("x", "Doc/n:d1/")] == 7


def test_new_properties_join_and_types_are_kept(table, frame):
    wider = ef.Schema("Doc", {"value": ef.Field(ef.Int64Type()), "extra": ef.Field(ef.StringType())}, key=DOC.key)
    ef.write_entities(table.store, frame([("x", "d1", 1, "e")], DDL + ", extra string"), wider)
    rows = table.read()
    assert rows.filter("extra = 'e'").count() == 1 and rows.filter("extra is null").count() == 59
    retyped = ef.Schema("Doc", {"value": ef.Field(ef.StringType())}, key=DOC.key)
    with pytest.raises(ef.SchemaError, match="stored as bigint"):
        ef.write_entities(table.store, frame([("x", "d1", "1")], "ns string, doc_id string, value string"), retyped)


def test_one_shuffle_per_merge(spark, table, frame):
    from entityframe.sources.store import merge_rows, pair_rows

    properties = table.snapshot().properties
    existing = table.read()
    for folders in ([fv.NS, fv.BUCKET], [fv.BUCKET]):
        merged = merge_rows(pair_rows(existing, existing, properties, folders), properties, "put")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_odd_namespaces(store, frame):
    names = ["@", "", "a/b", "a=b", "007", "é ü", "%", None]
    ef.write_entities(store, frame([(n, "d", i) for i, n in enumerate(names)], DDL), DOC)
    rows = ef.read_entities(store, "Doc", schema=DOC, include_key=True)
    assert {r.value: r[fv.KEY].namespace for r in rows.collect()} == dict(enumerate(names))
    for i, name in enumerate(names):
        scope = ef.EntityKey((("Doc", "d"),), namespace=name)
        assert [r.value for r in ef.read_entities(store, "Doc", schema=DOC, ancestor=scope).collect()] == [i]


def rows_per_file(df):
    rows = df.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), fv.NS, fv.PATH)
    seen = {}
    for r in rows.orderBy("f", "i").collect():
        seen.setdefault(r.f, []).append((r[fv.NS], r[fv.PATH]))
    return list(seen.values())


def test_rows_sorted_by_path_inside_files(table, flat_table):
    for files in (rows_per_file(table.read()), rows_per_file(flat_table.read())):
        assert all(rows == sorted(rows) for rows in files)
    # Without namespace folders there is one file per bucket, whatever the namespaces.
    assert len(rows_per_file(flat_table.read())) == 3


def test_pages_and_chunks(table):
    accessor = ef.kind(schema=DOC, store=table.store)
    keys = sorted(values(table.read()))
    got, after = [], None
    while True:
        page = accessor.page(7, after=after)
        if page.next is None:
            break
        got += [r.value for r in page.rows.collect()]
        after = page.next
    by_key = values(table.read())
    assert got == [by_key[k] for k in keys]
    chunks = [[r.value for r in c.collect()] for c in accessor.iter(chunksize=25)]
    assert [len(c) for c in chunks] == [25, 25, 10]
    assert sorted(v for c in chunks for v in c) == sorted(by_key.values())
    small = accessor.page(5, filters=[("value", ">", 17)])
    assert small.rows.count() == 5


def test_utc_is_required(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ef.SchemaError):
            ef.EntityStore(spark, "/nowhere")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_second_of_two_writers_is_told(table, frame):
    before = table.snapshot()
    changed = table.read().withColumn("value", F.lit(1).cast("bigint"))
    table.merge(changed.filter("value = 1"), "put")
    live = table.snapshot().partitions
    # The slower writer has read the same version; it neither wins nor loses anybody's rows.
    with pytest.raises(ef.WriteConflictError):
        table.merge(table.read(before).limit(1), "put", before)
    with pytest.raises(ef.WriteConflictError):
        table._publish(before, frozenset(), before.properties)
    assert table.snapshot().partitions == live
    assert {r.value for r in table.read().collect()} == {1}


def test_a_claim_is_created_once(spark, tmp_path):
    from entityframe.sources.pointer import create_if_absent, names_in, read_text

    path = f"{tmp_path}/claims/1"
    assert create_if_absent(spark, path, "first") and not create_if_absent(spark, path, "second")
    assert read_text(spark, path) == "first" and names_in(spark, f"{tmp_path}/claims") == ["1"]
    assert names_in(spark, f"{tmp_path}/none") == []


def test_classification_and_commit_use_one_version(table, frame, monkeypatch):
    """A row that another writer inserts in between is not written over."""
    from entityframe.sources.store import EntityTable

    true = EntityTable.read_for
    raced = []

    def read_for(self, batch, snapshot):
        found = true(self, batch, snapshot)
        if not raced:
            raced.append(1)
            ef.write_entities(table.store, frame([("x", "new", 100)], DDL), DOC)
        return found

    monkeypatch.setattr(EntityTable, "read_for", read_for)
    with pytest.raises(ef.WriteConflictError):
        ef.write_entities(table.store, frame([("x", "new", 7)], DDL), DOC, mode="insert")
    assert table.read().filter("value = 100").count() == 1 and table.read().filter(F.col(fv.PATH).contains("new")).count() == 1


def test_a_large_partition_is_several_tasks(spark, frame, tmp_path):
    store = ef.EntityStore(spark, str(tmp_path), buckets=1, task_bytes=20_000)
    rows = [("x", f"d{i}", i) for i in range(4000)]
    ef.write_entities(store, frame(rows, DDL), DOC)
    ef.write_entities(store, frame(rows[:50], DDL), DOC)
    table = store.table("Doc")
    files = rows_per_file(table.read())
    assert len(files) > 1 and all(r == sorted(r) for r in files)
    assert sorted(values(table.read()).values()) == list(range(4000))


def test_a_partition_of_many_rows_is_several_tasks(spark, frame, tmp_path):
    """However well its files shrink; other partitions are not cut."""
    store = ef.EntityStore(spark, str(tmp_path), buckets=1, task_rows=500)
    rows = [("x", f"d{i}", 7) for i in range(2000)] + [("y", "d", 8)]
    ef.write_entities(store, frame(rows, DDL), DOC)
    ef.write_entities(store, frame([("x", f"d{i}", 9) for i in range(50)], DDL), DOC)
    files = rows_per_file(store.table("Doc").read())
    assert max(map(len, files)) < 1000 and all(r == sorted(r) for r in files)
    assert sum(map(len, files)) == 2001


def test_a_staged_table_is_read_by_several_tasks(spark):
    """Also where one task wrote it; and its rows are encoded in methods the JVM compiles."""
    from entityframe.sources import staging

    wide = spark.range(0, 2_000_000, 1, 1).select("id", F.hash("id").alias("a"), F.xxhash64("id").alias("b"))
    seen = []
    with staging.compiled(spark):
        seen.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    assert seen == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
    rows = staging.stage(wide)
    read = rows.select("id").groupBy(F.spark_partition_id()).count().collect()
    assert len([r for r in read if r["count"] > 0]) > 1


def test_touched_partitions_do_not_grow_with_namespaces(spark, frame, tmp_path):
    store = ef.EntityStore(spark, str(tmp_path), buckets=2, by_namespace=False)
    ef.write_entities(store, frame([(f"n{i}", "d", i) for i in range(300)], DDL), DOC)
    table = store.table("Doc")
    assert table._touched(table.snapshot(), table.read()) == {(None, 0), (None, 1)}
    assert table.expire() == []


def test_expire_names_what_only_old_versions_read(table):
    changed = table.read().withColumn("value", F.lit(1).cast("bigint"))
    old = {w for _, _, w in table.snapshot().partitions}
    table.merge(changed, "put")
    assert set(table.expire()) == old and not set(table.expire(keep=2)) & old


def test_scratch_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    from entityframe.sources import staging

    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ef.SchemaError):
        staging.shared_folder(Cluster)


def test_empty_batches(table, frame):
    empty = frame([], DDL)
    for options in ({}, {"skip_unchanged": True}, {"mode": "insert"}, {"dry_run": True}):
        report = ef.write_entities(table.store, empty, DOC, **options)
        assert (report.totals.rows, report.wrote) == (0, 0)
    filtered = frame([("x", "d1", 1)], DDL).filter("value > 5")
    assert ef.patch_entities(table.store, filtered, DOC, properties=["value"]).totals.rows == 0
    assert table.snapshot().version == 1


def test_a_batch_of_errors_writes_nothing(table, frame):
    strict = ef.Schema("Doc", {"value": ef.Field(ef.Int64Type(), nullable=False)}, key=DOC.key)
    report = ef.write_entities(table.store, frame([("x", "d1", None)], DDL), strict)
    assert (report.failed, report.wrote) == (1, 0) and table.snapshot().version == 1
