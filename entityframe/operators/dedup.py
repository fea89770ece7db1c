"""Logical duplicates: which rows of a group stay, which are planned for deletion."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import KeyValidationError, SchemaError
from entityframe.functions.keys import key_is_complete, key_ns_code, key_path_text
from entityframe.functions.logical import comparable
from entityframe.plans.write_plan import PROPERTIES, ROW_INDEX, WritePlan
from entityframe.schema import column, field_types


def _order_columns(order: Sequence[str], keep: str, fields: dict, tie: Sequence[Column]) -> list:
    """Ascending puts NULL last, descending puts it first; "last" turns it all round,
    ties included."""
    if keep not in ("first", "last"):
        raise SchemaError("keep must be 'first' or 'last'")
    flip = keep == "last"
    sort = []
    for item in order:
        name, descending = (item[1:], True) if item.startswith("-") else (item, False)
        if name not in fields:
            continue
        value = comparable(column(name), fields[name])
        if descending != flip:
            sort.append(value.desc_nulls_first())
        else:
            sort.append(value.asc_nulls_last())
    return sort + [t.desc() if flip else t.asc() for t in tie]


def survivors(
    df: DataFrame,
    by: Sequence[str],
    *,
    order: Sequence[str] = (),
    keep: str = "first",
    tie: Sequence[str] = (fv.NS, fv.PATH),
) -> DataFrame:
    """The row of each group that stays.

    `tie` must identify a row.  The `row_number() = 1` filter runs on the map side
    first, so each task passes on at most one row per group however large the group.
    Rows with a NaN in `by` match no other row and all stay.
    """
    pool, loose = _grouped(df, by)
    kept = pool.withColumn(_RANK, _rank(order, keep, field_types(df), tie)).filter(F.col(_RANK) == 1)
    kept = kept.drop(_RANK, *_GROUP)
    return kept if loose is None else kept.unionByName(loose)


# Two different 64-bit digests of the grouping values, which can be long texts, and nested values.
_GROUP = ("__g1__", "__g2__", "__g3__")
_RANK = "__rank__"


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows that can have duplicates, with the digests of their group; and those that cannot."""
    if not by:
        raise SchemaError("duplicate cleanup needs at least one grouping field")
    fields = field_types(df)
    nan = _nan_in(by, fields)
    pool = df if nan is None else df.filter(~nan)
    values = {n: comparable(column(n), fields[n]) for n in by if n in fields}
    # Digests skip nulls, so a null's place is told; nested values, in which one cannot tell,
    # are grouped by as they are.
    nested = [v for n, v in values.items() if isinstance(fields[n], (T.ArrayType, T.StructType))]
    marked = [part for n, v in values.items() for part in (v.isNull(), v) if not isinstance(fields[n], (T.ArrayType, T.StructType))]
    digests = {
        _GROUP[0]: F.xxhash64(F.lit(0), *marked),
        _GROUP[1]: F.xxhash64(F.lit(1), *marked),
        _GROUP[2]: F.struct(*nested) if nested else F.lit(0),
    }
    return pool.withColumns(digests), None if nan is None else df.filter(nan)


def _rank(order: Sequence[str], keep: str, fields: dict, tie: Sequence[str]) -> Column:
    sort = _order_columns(order, keep, fields, [column(t) for t in tie])
    return F.row_number().over(Window.partitionBy(*_GROUP).orderBy(*sort))


def surplus(
    df: DataFrame,
    by: Sequence[str],
    *,
    order: Sequence[str] = (),
    keep: str = "first",
    tie: Sequence[str] = (fv.NS, fv.PATH),
) -> DataFrame:
    """The rows that do not stay.

    The survivors are found among the digests, the order and the identity of the rows, so the
    grouping values are not shuffled.  Every other row is surplus: an anti join on the unique
    row identity, whose key has no hot values.
    """
    fields = field_types(df)
    pool, _ = _grouped(df, by)
    needed = dict.fromkeys([*[i.lstrip("-") for i in order if i.lstrip("-") in fields], *tie])
    slim = pool.select(*_GROUP, *[column(n) for n in needed])
    kept = slim.withColumn(_RANK, _rank(order, keep, fields, tie)).filter(F.col(_RANK) == 1)
    renamed = kept.select(*[column(t).alias(f"__k{i}__") for i, t in enumerate(tie)])
    match = reduce(
        Column.__and__, [pool[t].eqNullSafe(renamed[f"__k{i}__"]) for i, t in enumerate(tie)]
    )
    return pool.join(renamed, match, "left_anti").drop(*_GROUP)


def plan_duplicate_cleanup(
    df: DataFrame,
    by: Sequence[str],
    *,
    order: Sequence[str] = (),
    keep: str = "first",
    row_index: str | None = None,
) -> WritePlan:
    """Delete plan for the surplus rows of a frame with `__key__`."""
    fields = field_types(df)
    if fv.KEY not in fields:
        raise SchemaError("duplicate cleanup needs a __key__ column")
    if fv.PATH not in fields:
        key = F.col(fv.KEY)
        df = df.withColumns({fv.NS: key_ns_code(key), fv.PATH: key_path_text(key)})
    _require_identity(df)
    extra = surplus(df, by, order=order, keep=keep)
    values = F.struct(*[column(n).alias(n) for n in by if n in fields])
    text = F.lit(None).cast("string")
    index = F.col(fv.PATH) if row_index is None else column(row_index)
    planned = extra.select(
        index.alias(ROW_INDEX),
        F.lit("delete").alias("action"),
        F.col(fv.KEY),
        F.array().cast("array<string>").alias(fv.PRESENT),
        F.array().cast("array<string>").alias(fv.UNINDEXED),
        F.concat(F.lit("duplicate group "), F.to_json(values, {"ignoreNullFields": "false"})).alias(
            "reason"
        ),
        text.alias("error"),
        text.alias("key_error"),
        F.lit(False).alias("incomplete"),
        F.col(fv.NS),
        F.col(fv.PATH),
        values.alias(PROPERTIES),
        F.lit(True).alias("should_write"),
    )
    return WritePlan(planned, "delete")


def _nan_in(by: Sequence[str], fields: dict[str, T.DataType]) -> Column | None:
    floats = [n for n in by if isinstance(fields.get(n), (T.FloatType, T.DoubleType))]
    if not floats:
        return None
    return reduce(Column.__or__, [F.coalesce(F.isnan(column(n)), F.lit(False)) for n in floats])


def _require_identity(df: DataFrame) -> None:
    """Deleting goes by key, so each row needs a complete key of its own.

    Entities of a store have that; a caller's frame may not.  One aggregate over the keys, summed
    before the shuffle, tells.
    """
    complete = F.coalesce(key_is_complete(F.col(fv.KEY)), F.lit(False))
    counted = df.groupBy(fv.NS, fv.PATH).agg(F.count(F.lit(1)).alias("rows"), F.min(complete).alias("complete"))
    row = counted.agg(F.max("rows").alias("most"), F.min("complete").alias("complete")).first()
    if row["complete"] is False:
        raise KeyValidationError("duplicate cleanup needs complete keys")
    if (row["most"] or 0) > 1:
        raise KeyValidationError("duplicate cleanup needs a key of its own for each row")
