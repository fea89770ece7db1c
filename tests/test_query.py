from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.functions.keys import key_ns_code, key_path_text
from entityframe.plans.query import QuerySpec

ANCESTOR = ef.EntityKey((("User", "a"),), namespace="n")


@pytest.fixture
def rows(frame):
    spec = ef.key_policy("W", id_field="w", id_kind="id", namespace_field="ns", ancestors=[("User", "u")])
    df = frame(
        [
            ("n", "a", 1, "run", 5.0),
            ("n", "a", 2, "run", None),
            ("n", "ab", 3, "bike", 7.0),
            ("m", "a", 4, None, 1.0),
            (None, "a", 5, "bike", 7.0),
        ],
        "ns string, u string, w int, kind string, value double",
    )
    made = spec.build({f.name: f.dataType for f in df.schema.fields})
    keyed = df.withColumn(fv.KEY, made.value)
    return keyed.withColumns({fv.NS: key_ns_code(F.col(fv.KEY)), fv.PATH: key_path_text(F.col(fv.KEY))})


def ids(df):
    return [r.w for r in df.collect()]


def found(rows, **options):
    return sorted(ids(QuerySpec("W", **options).apply(rows)))


@pytest.mark.parametrize(
    "options",
    [
        {"namespace": "x", "ancestor": ANCESTOR},
        {"keys_only": True, "projection": ["a"]},
        {"filters": [("a", ">", 1)], "order": ["b", "a"]},
        {"filters": [("a", "NOT_IN", [1])], "order": ["b"]},
        {"distinct_on": ["a", "b"], "order": ["b", "a"]},
        {"filters": [("a", "=", 1)], "projection": ["a", "b"]},
        {"filters": [("a", "~", 1)]},
        {"limit": -1},
        {"order": ["a"], "after": ef.PagePosition("@", "A/n:a/")},
    ],
)
def test_rejected_shapes(options):
    with pytest.raises(ef.QueryValidationError):
        QuerySpec("W", **options).validate()


@pytest.mark.parametrize(
    "options",
    [
        {"namespace": "n", "ancestor": ANCESTOR},
        {"filters": [("a", ">", 1)], "order": ["-a", "b"]},
        {"filters": [("a", "IN", [1])], "order": ["b"]},  # T30
        {"filters": [("a", "IN", [1])], "projection": ["a"]},  # T30
        {"distinct_on": ["a"], "order": ["-a", "b"]},
        {"distinct_on": ["a"]},
    ],
)
def test_accepted_shapes(options):
    QuerySpec("W", **options).validate()


def test_comparisons(rows):
    assert found(rows, filters=[("value", "=", 7.0)]) == [3, 5]
    assert found(rows, filters=[("value", "!=", 7.0)]) == [1, 4]
    assert found(rows, filters=[("value", "<", 5.0)]) == [4]
    assert found(rows, filters=[("value", "<=", 5.0)]) == [1, 4]
    assert found(rows, filters=[("value", ">", 5.0), ("kind", "=", "bike")]) == [3, 5]
    assert found(rows, filters=[("value", ">=", 7.0), ("w", "<", 4)]) == [3]


def test_membership(rows):
    assert found(rows, filters=[("kind", "IN", ["run", "swim"])]) == [1, 2]
    assert found(rows, filters=[("kind", "NOT_IN", ["run"])]) == [3, 5]
    assert found(rows, filters=[("kind", "IN", [])]) == []
    assert found(rows, filters=[("kind", "NOT_IN", [])]) == [1, 2, 3, 5]
    assert found(rows, filters=[("kind", "IN", ["run", None])]) == [1, 2, 4]


LONG = 2500


def test_long_lists_follow_the_rules_of_short_ones(rows):
    for pad in ([float(n) for n in range(100, 100 + LONG)], list(range(100, 100 + LONG))):
        for short in ([5, 7], [5.0, 7.0], [5, 7.0], [7, None], [None]):
            for op in ("IN", "NOT_IN"):
                want = found(rows, filters=[("value", op, short)])
                assert found(rows, filters=[("value", op, [*short, *pad])]) == want
    assert found(rows, filters=[("w", "IN", [1.0, 2.0, *map(float, range(100, LONG))])]) == found(rows, filters=[("w", "IN", [1, 2])])
    names = [f"x{n}" for n in range(LONG)]
    assert found(rows, filters=[("kind", "IN", ["run", None, *names])]) == [1, 2, 4]


def test_literals_of_long_lists(spark):
    utc, nan = timezone.utc, float("nan")
    values = {
        "string": ["a", "it's", 'q"\\n', "é\n%_", "", "\\'"],
        "bigint": [1, -5, 2**31, -(2**63), 2**63 - 1],
        "double": [1.5, -0.0, 1e-300, 1e300, float("inf"), nan],
        "boolean": [True],
        "timestamp": [datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(1960, 5, 6, tzinfo=utc), datetime(2024, 7, 1, 12, 0, tzinfo=timezone(timedelta(hours=5)))],
        "date": [date(2024, 2, 29), date(1900, 1, 1)],
    }
    for kind, given in values.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, v {kind}")
        for part in ([v] for v in given):
            short = sorted(r.i for r in QuerySpec("W", filters=[("v", "IN", part)]).apply(df).collect())
            long = sorted(r.i for r in QuerySpec("W", filters=[("v", "IN", part * 30)]).apply(df).collect())
            assert short == long and len(short) == 1, (kind, part)


def test_long_lists_on_mixed_properties(spark):
    values = ['"a"', "1", "1.0", "true", "null", '"1"', "2.5", "[1]"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, j string").select("i", F.parse_json("j").alias("v"))
    pads = [f"x{n}" for n in range(LONG)], list(range(1000, 1000 + LONG))

    def ids(op, wanted):
        return sorted(r.i for r in QuerySpec("W", filters=[("v", op, wanted)]).apply(df).collect())

    for short, want in (([1], [1, 2]), (["a", True], [0, 3]), ([2.5, None], [4, 6]), ([], [])):
        for pad in ([], *pads):
            assert ids("IN", [*short, *pad]) == want
            assert ids("NOT_IN", [*short, *pad]) == [i for i in range(8) if i not in want]


def test_null_and_unknown_names(rows):
    assert found(rows, filters=[("kind", "=", None)]) == [4]
    assert found(rows, filters=[("kind", "!=", None)]) == [1, 2, 3, 5]
    assert found(rows, filters=[("nothing", "!=", 1)]) == []


def test_scope(rows):  # T21
    assert found(rows, namespace="n") == [1, 2, 3]
    assert found(rows, ancestor=ANCESTOR) == [1, 2]
    assert found(rows, ancestor=ef.EntityKey((("User", "a"),))) == [5]
    assert found(rows, ancestor=ANCESTOR.child("W", 1)) == [1]


def test_order_and_limit(rows):
    spec = QuerySpec("W", order=["-value", "w"])
    assert ids(spec.apply(rows))[:2] == [3, 5]
    assert len(ids(QuerySpec("W", order=["-value"], limit=3).apply(rows))) == 3
    assert ids(QuerySpec("W", order=["value"], require_present=True).apply(rows))[0] == 4


def test_distinct_on(rows):
    spec = QuerySpec("W", order=["kind", "-w"], distinct_on=["kind"])
    assert sorted(ids(spec.apply(rows))) == [2, 4, 5]
    lone = QuerySpec("W", projection=["kind"], distinct_on=["kind"]).apply(rows.drop(*fv.SYSTEM_COLUMNS))
    assert lone.columns == ["kind"] and lone.count() == 3


def test_distinct_on_prunes_hot_groups_before_the_shuffle(rows):
    spec = QuerySpec("W", order=["kind", "-w"], distinct_on=["kind"])
    plan = spec.apply(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_key_values(frame):
    df = frame(
        [(1, '{"path":[{"kind":"U","id":1}]}'), (2, '{"path":[{"kind":"U","name":"1"}]}'), (3, None)], "w int, j string"
    ).withColumn("k", F.from_json("j", ef.KEY_TYPE))
    one, named = ef.EntityKey((("U", 1),), project="p"), ef.EntityKey((("U", "1"),))
    assert found(df, filters=[("k", "=", one)]) == [1]
    assert found(df, filters=[("k", "IN", [one, named])]) == [1, 2]
    assert found(df, filters=[("k", "!=", one)]) == [2]
    assert found(df, filters=[("k", "=", None)]) == [3]
    with pytest.raises(ef.QueryValidationError):
        QuerySpec("W", filters=[("k", "=", "x")]).apply(df)


def test_mixed_property_matches_by_type(frame):
    df = frame([(1, "1"), (2, '"1"'), (3, "1.5"), (4, "null"), (5, "true")], "w int, j string")
    df = df.withColumn("v", F.parse_json("j"))
    assert found(df, filters=[("v", "=", 1)]) == [1]
    assert found(df, filters=[("v", "=", "1")]) == [2]
    assert found(df, filters=[("v", "IN", [1, "1"])]) == [1, 2]
    assert found(df, filters=[("v", "=", None)]) == [4]


def test_scope_reaches_the_parquet_reader(store, frame):
    schema = ef.Schema("W", {"v": ef.Field(ef.Int64Type())}, key=ef.key_policy("W", id_field="w", namespace_field="ns", ancestors=[("User", "u")]))
    ef.write_entities(store, frame([("n", "a", "1", 1), ("m", "b", "2", 2)], "ns string, u string, w string, v int"), schema)
    scan = ef.scan(store, QuerySpec("W", ancestor=ANCESTOR, filters=[("v", ">", 0)]))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(__path__,User/n:a/)" in plan and "GreaterThan(v,0)" in plan
    assert "PartitionFilters: [isnotnull(__ns__" in plan
    assert scan.count() == 1


def test_unused_columns_are_not_read(store, frame):
    schema = ef.Schema("W", {n: ef.Field(ef.Int64Type()) for n in ("v", "x")}, key=ef.key_policy("W", id_field="w"))
    ef.write_entities(store, frame([("1", 1, 2)], "w string, v int, x int"), schema)
    plan = ef.read_entities(store, "W", schema=schema, projection=["v"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:bigint>" in plan


def test_dates_in_filters(frame):
    start = datetime(2024, 1, 1)
    df = frame([(n, start + timedelta(days=n)) for n in range(4)], "w int, d timestamp_ntz")
    assert found(df, filters=[("d", ">=", start + timedelta(days=2))]) == [2, 3]
