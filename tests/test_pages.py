"""Pages in any order: walks against a sort in Python."""

import random
from datetime import datetime, timedelta
from functools import cmp_to_key

import pytest

import entityframe as ef
from entityframe import fixed_values as fv

SCHEMA = ef.Schema(
    "Row",
    {
        "n": ef.Field(ef.Int64Type()),
        "price": ef.Field(ef.Float64Type(), missing_policy="null"),
        "name": ef.Field(ef.StringType()),
        "at": ef.Field(ef.TimestampType()),
        "tags": ef.Field(ef.ArrayType(ef.Int64Type())),
        "data": ef.Field(ef.BlobType()),
        "owner": ef.Field(ef.KeyType()),
        "where": ef.Field(ef.GeoPointType()),
    },
    key=ef.key_policy("Row", id_field="n", namespace_field="space"),
    strict=False,
)
DDL = "n int, space string, price double, name string, at timestamp, tags array<int>, data binary"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(7)
    some = lambda *values: chance.choice([*values, None])
    return [
        (n, some("a", "b"), some(1.5, 2.5, -1.0), some("x", "y", "é"), some(START, START + timedelta(microseconds=1)), some([1], [1, 2], []), some(b"", b"\xff"))
        for n in range(120)
    ]


@pytest.fixture
def accessor(store, spark, rows):
    ef.write_entities(store, spark.createDataFrame(rows, DDL), SCHEMA).raise_for_errors()
    return ef.kind(schema=SCHEMA, store=store)


COLUMNS = ["n", "space", "price", "name", "at", "tags", "data"]


def expected(rows, order):
    """Row numbers in an order: nulls first when it ascends, last when it descends, then by key."""

    def compare(a, b):
        for item in order:
            at, sign = COLUMNS.index(item.removeprefix("-")), -1 if item.startswith("-") else 1
            x, y = a[at], b[at]
            if x != y:
                less = (x is None) if None in (x, y) else x < y
                return -sign if less else sign
        x, y = ((r[1] or "", f"{r[0]}") for r in (a, b))
        return (x > y) - (x < y)

    return [r[0] for r in sorted(rows, key=cmp_to_key(compare))]


def walk(accessor, size, **options):
    got, after, pages = [], None, 0
    while True:
        page = accessor.page(size, after=after, **options)
        if page.next is None:
            assert page.rows.count() == 0
            return got, pages
        found = [r.n for r in page.rows.collect()]
        assert len(found) == size or len(got) + len(found) <= 120
        got += found
        pages, after = pages + 1, page.next


@pytest.mark.parametrize(
    "order", [[], ["-price", "name"], ["price", "-name", "at"], ["-at"], ["tags", "-data"], ["-n"], ["data", "tags", "-price", "-at", "name"]]
)
def test_pages_are_the_sorted_rows_cut(accessor, rows, order):
    got, pages = walk(accessor, 17, order=order)
    assert got == expected(rows, order)
    assert pages == 8


def test_with_filters_and_a_namespace(accessor, rows):
    got, _ = walk(accessor, 5, order=["price", "name"], filters=[("price", ">", 0.0)], namespace="a")
    assert got == expected([r for r in rows if r[1] == "a" and r[2] is not None and r[2] > 0], ["price", "name"])


def test_keys_and_places_as_an_order(store, frame, spark):
    from pyspark.sql import functions as F

    base = spark.range(30).select(F.col("id").cast("int").alias("n"), F.lit(None).cast("string").alias("space"))
    spec = ef.key_policy("Owner", id_field="o")
    owned = base.withColumn("o", F.when(F.col("n") % 4 > 0, F.concat(F.lit("k"), (F.col("n") % 4).cast("string"))))
    built = spec.build({f.name: f.dataType for f in owned.schema.fields})
    place = F.struct((F.col("n") % 3).cast("double").alias("latitude"), F.lit(1.0).alias("longitude"))
    df = owned.withColumns({"owner": F.when(F.col("o").isNotNull(), built.value), "where": F.when(F.col("n") % 5 > 0, place)}).drop("o")
    ef.write_entities(store, df, SCHEMA).raise_for_errors()
    accessor = ef.kind(schema=SCHEMA, store=store)
    whole = [r.n for r in accessor.read(order=["-owner", "where"]).collect()]
    assert walk(accessor, 7, order=["-owner", "where"])[0] == whole
    assert len(whole) == 30


def test_distinct_rows_in_pages(accessor):
    order = ["name", "price"]
    whole = [r.n for r in accessor.read(order=order, distinct_on=order).collect()]
    got, _ = walk(accessor, 4, order=order, distinct_on=order)
    assert got == whole and len(got) == 16


def test_nothing_sorted_before_the_position_and_a_bound_for_the_reader(accessor):
    first = accessor.page(50, order=["-price", "name"])
    assert first.next.order == ("-price", "name") and len(first.next.values) == 2
    plan = accessor.page(10, after=first.next, order=["-price", "name"]).rows._jdf.queryExecution().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("LessThanOrEqual(price" in line for line in pushed)


def test_positions_of_other_orders_are_refused(accessor):
    first = accessor.page(5, order=["price"])
    for order in ([], ["-price"], ["price", "name"]):
        with pytest.raises(ef.QueryValidationError):
            accessor.page(5, after=first.next, order=order)


def test_unknown_properties_and_an_empty_kind(accessor, store, rows):
    assert walk(accessor, 50, order=["nothing", "n"])[0] == expected(rows, ["n"])
    nothing = ef.kind(schema=ef.Schema("None", {"v": ef.Field(ef.Int64Type())}), store=store)
    page = nothing.page(3, order=["v"])
    assert page.next is None and page.rows.collect() == []


def test_numbers_that_are_no_numbers(store, spark):
    schema = ef.Schema("F", {"n": ef.Field(ef.Int64Type())}, key=ef.key_policy("F", id_field="n"), strict=False)
    ef.write_entities(store, spark.range(9).selectExpr("cast(id as int) n"), schema).raise_for_errors()
    raw = store.table("F").read()
    from pyspark.sql import functions as F

    odd = raw.withColumn("x", F.when(F.col("n") % 3 == 0, F.lit(float("nan"))).when(F.col("n") % 3 == 1, F.lit(-0.0)).otherwise(0.0))
    from entityframe.plans.query import page_end

    whole = [r.n for r in ef.QuerySpec("F", order=["-x"]).apply(odd).collect()]
    got, after = [], None
    while end := page_end(ef.QuerySpec("F", order=["-x"], after=after), odd, 2):
        got += [r.n for r in ef.QuerySpec("F", order=["-x"], after=after, until=end).apply(odd).collect()]
        after = end
    assert got == whole
    assert fv.PATH in odd.columns
