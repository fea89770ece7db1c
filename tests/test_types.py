import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import entityframe as ef


@pytest.fixture
def encode(frame):
    def run(dtype, ddl, values, **options):
        df = frame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
        made = ef.Field(dtype, **options).encode("x", F.col("x"), df.schema["x"].dataType)
        rows = df.select("i", made.value.alias("v"), made.present.alias("p"), made.error.alias("e"))
        return [(r.v, r.p, r.e) for r in rows.orderBy("i").collect()]

    return run


def values(rows):
    return [v for v, _, _ in rows]


def failed(rows):
    return [e is not None for _, _, e in rows]


def test_int64_text(encode):
    rows = encode(ef.Int64Type(), "string", ["1", " 12 ", "1.5", "1_000", "x", "+7", "\t-3\n"])
    assert values(rows) == [1, 12, None, 1000, None, 7, -3]
    assert failed(rows) == [False, False, True, False, True, False, False]


def test_int64_numbers_are_cut_toward_zero(encode):
    rows = encode(ef.Int64Type(), "double", [1.9, -1.9, 1e30, float("inf")])
    assert values(rows) == [1, -1, None, None]
    assert failed(rows) == [False, False, True, True]


def test_int64_rejects_booleans(encode):
    assert failed(encode(ef.Int64Type(), "boolean", [True, None])) == [True, False]


def test_float64(encode):
    rows = encode(ef.Float64Type(), "string", ["1.5", "1.0d", "inf", "z", "2f"])
    assert values(rows)[0] == 1.5 and math.isinf(values(rows)[2])
    assert failed(rows) == [False, True, False, True, True]
    assert values(encode(ef.Float64Type(), "boolean", [True])) == [1.0]


def test_bool_words_then_truthiness(encode):
    rows = encode(ef.BoolType(), "string", ["TRUE", " yes\n", "1", "False", " NO ", "0", "maybe", "", "  "])
    assert values(rows) == [True, True, True, False, False, False, True, False, True]
    assert values(encode(ef.BoolType(), "double", [0.0, 0.5])) == [False, True]
    assert values(encode(ef.BoolType(), "array<int>", [[], [0]])) == [False, True]


def test_string_limit_counts_bytes_and_only_when_indexed(encode):
    texts = ["a" * 1500, "a" * 1501, "é" * 750, "é" * 751]
    assert failed(encode(ef.StringType(), "string", texts)) == [False, True, False, True]
    assert failed(encode(ef.StringType(), "string", texts, indexed=False)) == [False] * 4


def test_string_keeps_the_spark_text_of_other_types(encode):  # T8
    assert values(encode(ef.StringType(), "boolean", [True])) == ["true"]
    assert values(encode(ef.StringType(), "double", [1e16])) == ["1.0E16"]


def test_blob(encode):
    rows = encode(ef.BlobType(), "binary", [bytearray(b"x" * 1500), bytearray(b"x" * 1501)])
    assert failed(rows) == [False, True]
    assert failed(encode(ef.BlobType(), "string", ["x", None])) == [True, False]


def test_timestamp_nanoseconds_are_cut(encode):
    rows = encode(
        ef.TimestampType(), "string", ["2026-01-01T00:00:00.123456789Z", "2026-01-01 02:00:00+02:00", "bad"]
    )
    assert values(rows)[0].microsecond == 123456
    assert values(rows)[1] == values(encode(ef.TimestampType(), "string", ["2026-01-01 00:00:00"]))[0]
    assert failed(rows) == [False, False, True]


def test_timestamp_whole_numbers_are_nanoseconds_when_written(encode):
    df_rows = encode(ef.TimestampType(), "bigint", [1767225600123456789, -1])
    assert [v.microsecond for v in values(df_rows)] == [123456, 999999]


def test_timestamp_zone_of_naive_values(frame):
    df = frame([(datetime(2026, 7, 1, 12),)], "x timestamp_ntz")
    made = ef.Field(ef.TimestampType("America/New_York")).encode("x", F.col("x"), df.schema["x"].dataType)
    assert df.select(F.date_format(made.value, "HH:mm")).first()[0] == "16:00"


def test_timestamp_decode_of_microseconds(frame):
    df = frame([1767225600123456], "x bigint")
    got = df.select(ef.TimestampType().decode(F.col("x"), df.schema["x"].dataType).alias("t"))
    assert got.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] == "2026-01-01 00:00:00.123456"


def test_geo_point_shapes_and_ranges(encode):
    rows = encode(ef.GeoPointType(), "array<double>", [[1.0, 2.0, 3.0], [91.0, 0.0], [0.0, -181.0], [1.0], None])
    assert failed(rows) == [False, True, True, True, False]
    assert tuple(values(rows)[0]) == (1.0, 2.0)
    assert failed(
        encode(ef.GeoPointType(), "struct<latitude:double,longitude:double>", [(1.0, 2.0), (float("nan"), 0.0)])
    ) == [False, True]
    assert failed(
        encode(ef.GeoPointType(), "map<string,double>", [{"latitude": 1.0, "longitude": 2.0}, {"latitude": 1.0}])
    ) == [False, True]
    assert failed(encode(ef.GeoPointType(), "string", ["1,2"])) == [True]


def test_array_items(encode):
    rows = encode(ef.ArrayType(ef.Int64Type()), "array<string>", [["1", "2"], [], ["q"], ["1", None], None])
    assert values(rows)[:2] == [[1, 2], []]
    assert failed(rows) == [False, False, True, True, False]
    assert rows[4][1] is False


def test_array_of_text(encode):
    rows = encode(ef.ArrayType(ef.StringType()), "array<string>", [["a", None], ["x" * 1501]])
    assert values(rows)[0] == ["a", "None"]
    assert failed(rows) == [False, True]
    assert failed(encode(ef.ArrayType(ef.StringType()), "string", ["a"])) == [True]


def test_array_rejects_inner_arrays(encode):
    assert failed(encode(ef.ArrayType(ef.Int64Type()), "array<array<int>>", [[[1]], []])) == [True, False]


def test_key_property(encode):
    good = '{"path":[{"kind":"User","id":5}]}'
    both = '{"path":[{"kind":"User","id":5,"name":"x"}]}'
    zero = '{"path":[{"kind":"User","id":0}]}'
    rows = encode(ef.KeyType(), "string", [good, both, zero, "{", '{"path":[]}'])
    assert failed(rows) == [False, True, True, True, True]
    assert values(rows)[0].path[0].id == 5
    assert failed(encode(ef.KeyType(), "int", [1])) == [True]


def test_embedded_entity(encode, frame):
    rows = encode(ef.EmbeddedEntityType(), "struct<a:int,b:string>", [(1, "x")])
    assert values(rows)[0].toPython() == {"a": 1, "b": "x"}
    assert failed(encode(ef.EmbeddedEntityType(), "string", ["{}"])) == [True]
    assert values(encode(ef.EmbeddedEntityType(), "map<string,int>", [{"a": 1}]))[0].toPython() == {"a": 1}


def test_object_keeps_mixed_values(encode):
    rows = encode(ef.ObjectType(), "struct<a:int>", [(1,)])
    assert values(rows)[0].toPython() == {"a": 1}
    assert values(encode(ef.ObjectType(), "int", [3]))[0].toPython() == 3


def test_missing_is_null_or_nan_never_a_container(encode):  # T1
    rows = encode(ef.Float64Type(), "double", [float("nan"), None, 0.0])
    assert [p for _, p, _ in rows] == [False, False, True]
    assert encode(ef.ArrayType(ef.Float64Type()), "array<double>", [[]])[0][1] is True


def test_null_array_stays_null_on_decode(frame):  # T7
    df = frame([([1],), (None,)], "x array<bigint>")
    field = ef.Field(ef.ArrayType(ef.Int64Type()))
    got = [r.x for r in df.select(field.decode(F.col("x"), df.schema["x"].dataType).alias("x")).collect()]
    assert got == [[1], None]
