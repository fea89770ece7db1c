import pytest
from pyspark.sql import functions as F

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
    namespace_code,
    parse_key_json,
)


def build(spec, df):
    made = spec.build({f.name: f.dataType for f in df.schema.fields})
    rows = df.select(made.value.alias("k"), made.error.alias("e"))
    return rows.select("e", key_ns_code(F.col("k")).alias("ns"), key_path_text(F.col("k")).alias("path")).collect()


def test_build_from_columns(frame):
    spec = ef.KeySpec(
        [("User", ef.KeyPart("user")), ("Workout", ef.KeyPart("workout", kind="id"))], namespace_source="tenant"
    )
    rows = build(spec, frame([("t1", "sample-user", "42")], "tenant string, user string, workout string"))
    assert (rows[0].e, rows[0].ns, rows[0].path) == (None, "t1", "User/n:sample-user/Workout/i:42/")


def test_identifier_rules(frame):  # T10
    spec = ef.key_policy("W", id_field="w", id_kind="id")
    df = frame(["5", "-5", "0", "x", None], "w string")
    assert [r.e is None for r in build(spec, df)] == [True, True, False, False, False]
    names = ef.key_policy("W", id_field="w")
    assert [r.e is None for r in build(names, frame(["a", "", None, "__x__"], "w string"))] == [True, False, False, False]
    assert build(names, frame([7], "w int"))[0].path == "W/n:7/"
    assert build(spec, frame([True], "w boolean"))[0].e is not None


def test_auto_part_must_be_missing(frame):
    spec = ef.KeySpec([("W", ef.KeyPart("w", kind="auto"))])
    rows = build(spec, frame([None, "a"], "w string"))
    assert rows[0].e is None and rows[0].path == "W/-/" and rows[1].e is not None
    middle = ef.KeySpec([("U", ef.KeyPart("w", kind="auto")), ("W", ef.KeyPart("w2"))])
    assert build(middle, frame([(None, "a")], "w string, w2 string"))[0].e is not None


def test_key_policy_forms(frame):
    spec = ef.key_policy("W", key_field="w", ancestors=[("Shop", 5), ("Tag", ef.KeyPart(constant="x")), ("U", "u")])
    rows = build(spec, frame([("a", "b")], "u string, w string"))
    assert rows[0].path == "Shop/i:5/Tag/n:x/U/n:a/W/n:b/"
    with pytest.raises(ef.KeyValidationError):
        ef.key_policy("W")
    with pytest.raises(ef.KeyValidationError):
        ef.KeySpec.from_columns("W", ["a", "b"])
    assert ef.KeySpec.from_columns("W", "a", id_kind="id").sources == {"a"}


@pytest.mark.parametrize(  # T29
    "path",
    [(), (("", "a"),), (("__k__", "a"),), (("A", None), ("B", "x")), (("A", True),), (("A", 0),), (("A", ""),), (("A", "__n__"),)],
)
def test_invalid_literal_keys(path):
    with pytest.raises(ef.KeyValidationError):
        ef.EntityKey(path)


def test_literal_and_column_forms_agree(spark):
    for key in (
        ef.EntityKey((("User", "a/b%é"), ("W", 12)), namespace="t"),
        ef.EntityKey((("User", "x"), ("W", None)), project="p", database="d"),
        ef.EntityKey((("U", "1"),), namespace="@x"),
        ef.EntityKey((("U", 1),), namespace=""),
    ):
        row = spark.range(1).select(key.to_column().alias("k")).select(
            key_json(F.col("k")), key_ns_code(F.col("k")), key_path_text(F.col("k")), key_is_complete(F.col("k"))
        ).first()
        assert tuple(row) == (key.to_json(), key.ns_code, key.path_text, key.is_complete)
        assert ef.EntityKey.from_json(key.to_json()) == key


def test_ids_and_names_differ():
    assert ef.EntityKey((("U", 123),)) != ef.EntityKey((("U", "123"),))
    assert ef.EntityKey((("U", 123),)).path_text != ef.EntityKey((("U", "123"),)).path_text


def test_flat_path_and_partition(spark):
    key = ef.EntityKey((("U", "a"), ("W", 2)), project="p", namespace="n")
    assert key.flat_path == ("U", "a", "W", 2)
    assert key.without_partition() == ef.EntityKey(key.path)
    row = spark.range(1).select(key.to_column().alias("k")).select(
        key_flat_path(F.col("k")), key_json(key_without_partition(F.col("k")))
    ).first()
    assert row[0] == ["U", "a", "W", "2"] and row[1] == key.without_partition().to_json()


def test_contains():
    parent = ef.EntityKey((("U", "a"),), namespace="n")
    assert parent.contains(parent.child("W", 1)) and parent.contains(parent)
    assert not parent.contains(ef.EntityKey((("U", "ab"),), namespace="n"))
    assert not parent.contains(ef.EntityKey((("U", "a"), ("W", 1))))


def test_namespace_codes_do_not_collide():
    codes = [namespace_code(n) for n in (None, "", "@", "@-", "a", "@@")]
    assert len(set(codes)) == len(codes)


def test_column_rules(frame):
    element = '{"kind":"%s","id":%s,"name":%s}'
    cases = {
        element % ("A", 1, "null"): True,
        element % ("", 1, "null"): False,
        element % ("__A__", 1, "null"): False,
        element % ("A", 1, '"x"'): False,
        element % ("A", 0, "null"): False,
        element % ("A", "null", '""'): False,
        element % ("A", "null", '"__x__"'): False,
        element % ("A", "null", "null") + "," + element % ("B", 1, "null"): False,
        element % ("A", "null", "null"): True,
    }
    df = frame([f'{{"path":[{c}]}}' for c in cases], "j string")
    made = parse_key_json(F.col("j"))
    assert [r.ok for r in df.select(made.error.isNull().alias("ok")).collect()] == list(cases.values())
    assert df.limit(1).select(key_error(F.lit(None).cast(ef.KEY_TYPE))).first()[0] is None


def test_row_key_beats_recipe(frame):  # T9
    schema = ef.Schema("W", key=ef.key_policy("W", id_field="w"))
    df = frame([("a", '{"path":[{"kind":"X","id":9}]}'), ("b", None), ("c", "{")], f"w string, {fv.KEY} string")
    made = schema.key_columns(df)
    rows = df.select(key_path_text(made.value).alias("p"), made.error.alias("e")).collect()
    assert [r.p for r in rows[:2]] == ["X/i:9/", "W/n:b/"] and rows[2].e is not None
    with pytest.raises(ef.SchemaError):
        ef.Schema("W").key_columns(frame(["a"], "w string"))
    lone = ef.Schema("W").key_columns(df)
    assert [r.e is None for r in df.select(lone.error.alias("e")).collect()] == [True, False, False]
