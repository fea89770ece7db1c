import pytest
from pyspark.sql import functions as F

import entityframe as ef
from entityframe import fixed_values as fv
from entityframe.plans.write_plan import plan_rows

DOC = {"title": ef.Field(ef.StringType()), "note": ef.Field(ef.StringType())}


def schema(properties=None, **options):
    options.setdefault("key", ef.key_policy("Doc", id_field="doc_id"))
    return ef.Schema("Doc", DOC if properties is None else properties, **options)


def plan(frame, rows, ddl, contract, **options):
    made = plan_rows(frame(rows, ddl), contract, row_index="doc_id", **options).df
    return {r.row_index: r for r in made.collect()}


def test_missing_cell_is_omitted_by_default(frame):
    rows = plan(frame, [("a", "t", None)], "doc_id string, title string, note string", schema())
    assert rows["a"][fv.PRESENT] == ["title"]


def test_null_policy_stores_null(frame):
    contract = schema({"note": ef.Field(ef.StringType(), missing_policy="null")})
    rows = plan(frame, [("a", None)], "doc_id string, note string", contract)
    assert rows["a"][fv.PRESENT] == ["note"] and rows["a"].properties.note is None


def test_error_policy_fails_even_when_nullable(frame):  # T3
    contract = schema({"note": ef.Field(ef.StringType(), missing_policy="error")})
    rows = plan(frame, [("a", None), ("b", "x")], "doc_id string, note string", contract)
    assert rows["a"].action == "error" and rows["b"].error is None


def test_default_does_not_rescue_required_fields_in_full_writes(frame):  # T2
    contract = schema({"note": ef.Field(ef.StringType(), nullable=False, default="d")})
    full = plan(frame, [("a", None)], "doc_id string, note string", contract)
    assert full["a"].error == "missing required fields: note"
    patched = plan(
        frame, [("a", None)], "doc_id string, note string", contract, operation="patch", properties=["note"]
    )
    assert patched["a"].error is None and patched["a"].properties.note == "d"


def test_default_beats_the_policy(frame):
    contract = schema({"note": ef.Field(ef.StringType(), missing_policy="error", default=lambda: "made")})
    rows = plan(frame, [("a", None)], "doc_id string, note string", contract)
    assert rows["a"].properties.note == "made"


def test_defaults_are_converted_and_checked(frame):
    contract = schema({"n": ef.Field(ef.Int64Type(), default="12"), "t": ef.Field(ef.StringType(), default="x" * 1501)})
    rows = plan(frame, [("a", None, "ok")], "doc_id string, n string, t string", contract)
    assert rows["a"].properties.n == 12
    rows = plan(frame, [("a", None, None)], "doc_id string, n string, t string", contract)
    assert "1500" in rows["a"].error


def test_all_missing_required_names_are_listed(frame):
    contract = schema({n: ef.Field(ef.StringType(), nullable=False) for n in ("x", "y", "z")})
    rows = plan(frame, [("a", "1", None)], "doc_id string, x string, y string", contract)
    assert rows["a"].error == "missing required fields: y, z"


def test_strict_names_unknown_columns_that_hold_values(frame):  # T4
    ddl = "doc_id string, title string, z string, b double"
    contract = schema()
    rows = plan(
        frame, [("a", "t", "v", 1.0), ("b", "t", None, float("nan")), ("c", "t", None, 2.0)], ddl, contract
    )
    assert rows["a"].error == "unknown fields for strict schema: b, z"
    assert rows["b"].error is None
    assert rows["c"].error.endswith(": b")


def test_strict_ignores_key_and_namespace_sources(frame):  # T4
    key = ef.key_policy("Doc", id_field="doc_id", namespace_field="tenant", ancestors=[("User", "user")])
    rows = plan(
        frame, [("a", "u", "t1", "x")], "doc_id string, user string, tenant string, title string", schema(key=key)
    )
    assert rows["a"].error is None
    assert rows["a"][fv.NS] == "t1" and rows["a"][fv.PATH] == "User/n:u/Doc/n:a/"


def test_open_schema_ignores_unknown_columns(frame):
    rows = plan(frame, [("a", "v")], "doc_id string, other string", schema(strict=False))
    assert rows["a"].error is None and rows["a"][fv.PRESENT] == []


def test_property_lists(frame):  # T5, T6
    ddl, data = "doc_id string, title string, note string", [("a", "t", "n")]
    assert plan(frame, data, ddl, schema())["a"][fv.PRESENT] == ["note", "title"]
    assert plan(frame, data, ddl, schema(), properties=[])["a"][fv.PRESENT] == []
    assert plan(frame, data, ddl, schema(), properties=["note"])["a"][fv.PRESENT] == ["note"]
    assert "not declared" in plan(frame, data, ddl, schema(), properties=["note", "q"])["a"].error
    loose = plan(frame, data, ddl, schema(strict=False), properties=["note", "q"])
    assert loose["a"][fv.PRESENT] == ["note"]


def test_unindexed_names(frame):
    contract = schema({"title": ef.Field(ef.StringType()), "note": ef.Field(ef.StringType(), indexed=False)})
    rows = plan(frame, [("a", "t", "n"), ("b", "t", None)], "doc_id string, title string, note string", contract)
    assert rows["a"][fv.UNINDEXED] == ["note"] and rows["b"][fv.UNINDEXED] == []


def test_first_error_in_declared_order_wins(frame):
    contract = schema({"x": ef.Field(ef.Int64Type()), "y": ef.Field(ef.Int64Type())})
    rows = plan(frame, [("a", "bad1", "bad2")], "doc_id string, x string, y string", contract)
    assert "bad1" in rows["a"].error


def test_error_rows_carry_no_values(frame):
    contract = schema({"x": ef.Field(ef.Int64Type())})
    row = plan(frame, [("a", "bad")], "doc_id string, x string", contract)["a"]
    assert row[fv.KEY] is None and row.properties is None and row.should_write is False


def test_decode_strict_and_loose(frame):
    df = frame([("t", 1)], "title string, extra int")
    assert schema().decode(df).columns == ["title"]
    assert schema(strict=False).decode(df).columns == ["title", "extra"]


def test_bad_declarations():
    with pytest.raises(ef.SchemaError):
        ef.Field(ef.StringType(), missing_policy="drop")
    with pytest.raises(ef.SchemaError):
        ef.Field(ef.StringType(), default=None)
    with pytest.raises(ef.SchemaError):
        ef.Field("string")
    with pytest.raises(ef.SchemaError):
        ef.Schema("Doc", {fv.KEY: ef.Field(ef.StringType())})


def test_columns_with_dots(frame):
    contract = schema({"a.b": ef.Field(ef.Int64Type())})
    df = frame([("x", "5")], "doc_id string, `a.b` string")
    row = plan_rows(df, contract).df.select(F.col("properties")["a.b"].alias("v")).first()
    assert row.v == 5
