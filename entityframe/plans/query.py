"""Restricted scan: namespace, ancestor, conjunctive filters, projection, keys-only,
distinct-on, order, limit and keyset position, as one lazy DataFrame."""

from __future__ import annotations

import calendar
import math
import operator
import time
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import QueryValidationError
from entityframe.functions.keys import (
    EntityKey,
    key_ns_code,
    key_path_text,
    namespace_code,
)
from entityframe.functions.logical import is_key_type
from entityframe.schema import column, field_types

Filter = tuple[str, str, Any]

_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def _seek(position: PagePosition, fields: dict[str, T.DataType], tie: Column, *, forward: bool) -> list[Column]:
    """Rows behind (or, backwards, before) a position: the first property of the order that
    differs decides, and `tie` where none does.

    Ascending order has nulls first and descending order last, as in a sort.  The bound on the
    leading property stands by itself as well, since only that form reaches the Parquet reader.
    """
    leading: list[Column] = []
    for item, value in reversed(list(zip(position.order, position.values, strict=True))):
        name, descending = _split_order(item)
        if name not in fields:
            continue
        left, null = column(name), value is None
        right = literal(value, fields[name])
        upward = forward != descending
        if upward:
            beyond = left.isNotNull() if null else left > right
        else:
            beyond = F.lit(False) if null else (left < right) | left.isNull()
        tie = beyond | (left.eqNullSafe(right) & tie)
        leading = [] if null else [left >= right if upward else (left <= right) | left.isNull()]
    return [*leading, tie]


def literal(value: Any, dtype: T.DataType) -> Column:
    """A collected value as a column of its type; a timestamp is given in microseconds."""
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.StructType):
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.array(*[literal(v, dtype.elementType) for v in value]).cast(dtype)
    if isinstance(dtype, T.TimestampType) and isinstance(value, int):
        return F.timestamp_micros(F.lit(value).cast("bigint"))
    return F.lit(value).cast(dtype)


def _split_order(item: str) -> tuple[str, bool]:
    return (item[1:], True) if item.startswith("-") else (item, False)


@dataclass(frozen=True)
class PagePosition:
    """Last row of a page; the next page starts right after it.

    `values` are that row's values of the properties in `order`, the order of the pages; both are
    empty for pages in key order.  Timestamps stand there as microseconds.
    """

    ns_code: str
    path_text: str
    order: tuple[str, ...] = ()
    values: tuple[Any, ...] = ()


@dataclass(frozen=True)
class QuerySpec:
    kind: str
    namespace: str | None = None
    filters: Sequence[Filter] = ()
    order: Sequence[str] = ()
    projection: Sequence[str] | None = None
    distinct_on: Sequence[str] | None = None
    ancestor: EntityKey | None = None
    keys_only: bool = False
    limit: int | None = None
    after: PagePosition | None = None
    until: PagePosition | None = None
    require_present: bool = False

    # --- rules, checked before anything is planned ---

    def validate(self) -> None:
        for _, op, _ in self.filters:
            if op not in fv.FILTER_OPS:
                raise QueryValidationError(f"unknown filter operator: {op!r}")
        for name, op, value in self.filters:
            if isinstance(value, DataFrame) and (op not in ("IN", "NOT_IN") or len(value.columns) != 1):
                raise QueryValidationError(f"{name} {op}: a table can only be searched, and has one column")
        if self.ancestor and self.namespace not in (None, self.ancestor.namespace):
            raise QueryValidationError("the namespace differs from the one of the ancestor key")
        if self.keys_only and self.projection:
            raise QueryValidationError("keys_only leaves no properties to project")
        ordered = [_split_order(item)[0] for item in self.order]
        ranged = {name for name, op, _ in self.filters if op in fv.INEQUALITY_OPS}
        if ordered and ranged and ordered[0] not in ranged:
            raise QueryValidationError("the first sort property must be an inequality property")
        leading = list(self.distinct_on or ())
        if ordered and leading and ordered[: len(leading)] != leading:
            raise QueryValidationError("the distinct_on properties must lead the order")
        fixed = {name for name, op, _ in self.filters if op == "="}
        overlap = sorted(fixed.intersection(self.projection or ()))
        if overlap:
            raise QueryValidationError(
                "equality-filtered properties cannot be projected: " + ", ".join(overlap)
            )
        if self.limit is not None and self.limit < 0:
            raise QueryValidationError("limit must not be negative")
        for position in (self.after, self.until):
            if position and tuple(position.order) != tuple(self.order):
                raise QueryValidationError("the page position belongs to another order")

    # --- the scan ---

    def apply(self, df: DataFrame) -> DataFrame:
        """Filter, order and cut `df`; keeps the key columns, drops unprojected ones."""
        fields = field_types(df)
        rows = self._ordered(self.matching(df), fields)
        if self.limit is not None:
            rows = rows.limit(self.limit)
        return self._columns(rows, fields)

    def matching(self, df: DataFrame) -> DataFrame:
        """The rows between the page positions, neither ordered nor cut."""
        self.validate()
        fields = field_types(df)
        rows = self._select_rows(df, fields)
        if self.distinct_on:
            rows = self._first_per_combination(rows, fields)
        between = self._range_conditions(fields)
        return rows.filter(reduce(Column.__and__, between)) if between else rows

    def _select_rows(self, df: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
        conditions: list[Column] = []
        namespace = self.ancestor.namespace if self.ancestor else self.namespace
        if self.ancestor is not None or namespace is not None:
            conditions.append(F.col(fv.NS) == namespace_code(namespace))
        if self.ancestor is not None:
            conditions.append(F.startswith(F.col(fv.PATH), F.lit(self.ancestor.path_text)))
        tables = [f for f in self.filters if isinstance(f[2], DataFrame)]
        conditions += [condition(*f, fields) for f in self.filters if not isinstance(f[2], DataFrame)]
        if self.require_present:
            conditions += [
                column(n).isNotNull() for n, _ in map(_split_order, self.order) if n in fields
            ]
        rows = df.filter(reduce(Column.__and__, conditions)) if conditions else df
        for name, op, values in tables:
            rows = in_table(rows, name, values) if op == "IN" else not_in_table(rows, name, values)
        return rows

    def _range_conditions(self, fields: dict[str, T.DataType]) -> list[Column]:
        """Rows after one position, up to and including another."""
        ns, path, low, high = F.col(fv.NS), F.col(fv.PATH), self.after, self.until
        if low and high and not self.order and low.ns_code == high.ns_code:
            # One namespace: plain bounds, which reach the Parquet reader.
            return [ns == low.ns_code, path > low.path_text, path <= high.path_text]
        found = []
        if low:
            behind = (ns > low.ns_code) | ((ns == low.ns_code) & (path > low.path_text))
            found += _seek(low, fields, behind, forward=True)
        if high:
            within = (ns < high.ns_code) | ((ns == high.ns_code) & (path <= high.path_text))
            found += _seek(high, fields, within, forward=False)
        return found

    def _first_per_combination(self, rows: DataFrame, fields: dict) -> DataFrame:
        """One row per combination.  `row_number() = 1` lets Spark keep at most one
        row per group on each map task, so a hot combination is not shuffled whole."""
        on = list(self.distinct_on)
        rest = [i for i in self.order if _split_order(i)[0] not in on]
        sort = [_sort_column(i) for i in rest if _split_order(i)[0] in fields]
        sort += _key_order(fields)
        if not sort:
            return rows.dropDuplicates(on)
        window = Window.partitionBy(*[column(n) for n in on]).orderBy(*sort)
        rank = "__rank__"
        return rows.withColumn(rank, F.row_number().over(window)).filter(
            F.col(rank) == 1
        ).drop(rank)

    def _ordered(self, rows: DataFrame, fields: dict) -> DataFrame:
        sort = [_sort_column(i) for i in self.order if _split_order(i)[0] in fields]
        if not sort and self.after is None and self.until is None:
            return rows
        return rows.orderBy(*sort, *_key_order(fields))

    def _columns(self, rows: DataFrame, fields: dict) -> DataFrame:
        system = [F.col(n) for n in fv.SYSTEM_COLUMNS if n in fields and n != fv.DIGEST]
        if self.keys_only:
            return rows.select(*system)
        if self.projection is None:
            return rows
        return rows.select(*[column(n) for n in self.projection if n in fields], *system)


def condition(name: str, op: str, value: Any, fields: dict[str, T.DataType]) -> Column:
    """One filter as a column.  A property no entity has never matches."""
    if op not in fv.FILTER_OPS:
        raise QueryValidationError(f"unknown filter operator: {op!r}")
    if name not in fields:
        return F.lit(False)
    left = column(name)
    if is_key_type(fields[name]):
        return _key_condition(left, op, value)
    if isinstance(fields[name], T.VariantType):
        return _variant_condition(left, name, op, value)
    if op in ("IN", "NOT_IN"):
        given = [v for v in value if v is not None]
        inside = _isin(left, _name(name), given)
        if op == "IN":
            return inside if len(given) == len(value) else inside | _stored_null(name, left, fields)
        return left.isNotNull() & ~inside if given else left.isNotNull()
    if value is None:
        if op == "=":
            return _stored_null(name, left, fields)
        if op == "!=":
            return left.isNotNull()
        return F.lit(False)
    return _COMPARE[op](left, value if isinstance(value, Column) else F.lit(value))


_MEMBER = "__member__"


def _members(df: DataFrame, name: str, values: DataFrame) -> tuple[Column, Column, DataFrame]:
    """What a property and the column of a table are compared by: the property's side, null where
    it can match nothing, the table's side, and the table with its column renamed."""
    own = field_types(df)[name]
    given = values.toDF(_MEMBER)
    held, member, kind = column(name), F.col(_MEMBER), given.schema[0].dataType
    if is_key_type(own):
        if not is_key_type(kind):
            raise QueryValidationError(f"{name} holds keys; a table of {kind.simpleString()} has none of them")
        text = lambda key: F.concat(key_ns_code(key), F.lit("\n"), key_path_text(key))
        return F.when(held.isNotNull(), text(held)), F.when(member.isNotNull(), text(member)), given
    if isinstance(own, T.VariantType):
        # As with a list, a value of mixed type is looked for among those of its own type.
        word = F.regexp_extract(F.schema_of_variant(held), "^([A-Z_]+)", 1)
        if isinstance(kind, (T.IntegralType, T.FractionalType)):
            whole = F.when(word == "BIGINT", _number(F.try_variant_get(held, "$", "bigint"), True))
            found = whole.when(word.isin(*_NUMBER_WORDS), _number(F.try_variant_get(held, "$", "double"), False))
            sought = _number(member, True) if isinstance(kind, T.IntegralType) else _number(member.cast("double"), False)
            return found, F.when(member.isNotNull(), sought), given
        for kinds, own_word, read in ((T.StringType, "STRING", "string"), (T.BooleanType, "BOOLEAN", "boolean")):
            if isinstance(kind, kinds):
                return F.when(word == own_word, F.try_variant_get(held, "$", read)), member, given
        raise QueryValidationError(f"cannot compare a mixed property with {kind.simpleString()}")
    return held, member, given


def _number(value: Column, whole: bool) -> Column:
    """A number in a form that is equal for equal whole numbers and fractions."""
    if whole:
        return F.struct(value.cast("bigint").alias("whole"), F.lit(None).cast("double").alias("part"))
    is_whole = (value == F.floor(value)) & (F.abs(value) < 2.0**63)
    return F.struct(F.when(is_whole, value.cast("bigint")).alias("whole"), F.when(~is_whole, value).alias("part"))


def in_table(df: DataFrame, name: str, values: DataFrame) -> DataFrame:
    """Rows whose property occurs in a one-column table, by the rules of a list: a NULL in the
    table stands for a stored null.

    An equi semi join, so the table may be of any size and may repeat values.  Rows without the
    property are not shuffled with the join: a null never equals a value.
    """
    fields = field_types(df)
    if name not in fields:
        return df.filter(F.lit(False))
    held, member, given = _members(df, name, values)
    met = df.withColumn("__held__", held).join(
        given.select(member.alias(_MEMBER)).filter(F.col(_MEMBER).isNotNull()), F.col("__held__") == F.col(_MEMBER), "left_semi"
    )
    null = F.is_variant_null(column(name)) if isinstance(fields[name], T.VariantType) else _stored_null(name, column(name), fields)
    some_null = given.filter(F.col(_MEMBER).isNull()).select(_MEMBER).exists()
    return met.drop("__held__").unionByName(df.filter(null & some_null))


def not_in_table(df: DataFrame, name: str, values: DataFrame) -> DataFrame:
    """Rows that hold the property with a value that no row of the table has; a NULL in the table
    excludes only the stored null of a mixed property, which is one of its values.

    A plain equi anti join, which also a large table can be shuffled for; SQL's own NOT IN would
    have to send the whole table to every task.
    """
    if name not in field_types(df):
        return df.filter(F.lit(False))
    held, member, given = _members(df, name, values)
    present = df.filter(column(name).isNotNull())
    if isinstance(field_types(df)[name], T.VariantType):
        some_null = given.filter(F.col(_MEMBER).isNull()).select(_MEMBER).exists()
        present = present.filter(~(F.is_variant_null(column(name)) & some_null))
    present = present.withColumn("__held__", held)
    members = given.select(member.alias(_MEMBER)).filter(F.col(_MEMBER).isNotNull())
    return present.join(members, F.col("__held__") == F.col(_MEMBER), "left_anti").drop("__held__")


def _isin(left: Column, text: str, values: Sequence[Any]) -> Column:
    """Membership as one set, whatever the length of the list; `text` is `left` in SQL.

    Whole numbers and fractions may meet in one list.  A long list is handed over as one text,
    since a call to the JVM for each value takes far longer than the query.
    """
    if not values:
        return F.lit(False)
    if any(isinstance(v, float) for v in values) and all(isinstance(v, (int, float)) for v in values):
        values = [float(v) for v in values]
    literals = [_sql_literal(v) for v in values] if len(values) > _FEW else [None]
    if None in literals:
        return left.isin(list(values))
    return F.expr(f"{text} IN ({', '.join(literals)})")


_FEW = 20


def _sql_literal(value: Any) -> str | None:
    """A plain value in SQL, with the type and meaning it has as a column; None for others."""
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return f"{value}" if -(2**31) <= value < 2**31 else f"{value}L" if -(2**63) <= value < 2**63 else None
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    if isinstance(value, str):
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    if isinstance(value, datetime):
        # Values without a zone are local time, as everywhere in the Python API.
        seconds = calendar.timegm(value.utctimetuple()) if value.tzinfo else time.mktime(value.timetuple())
        return f"timestamp_micros({int(seconds) * 1_000_000 + value.microsecond})"
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else None


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stored_null(name: str, left: Column, fields: dict[str, T.DataType]) -> Column:
    """Stored as null; an entity table also tells stored null from absent."""
    if fv.PRESENT in fields:
        return left.isNull() & F.array_contains(F.col(fv.PRESENT), name)
    return left.isNull()


def _key_condition(left: Column, op: str, value: Any) -> Column:
    """Keys compare by namespace and path: equality by their fields, order by their texts."""

    def key(given: Any) -> EntityKey:
        if not isinstance(given, EntityKey):
            raise QueryValidationError(f"a key property needs a key value, not {given!r}")
        return given

    def identity(of: Column) -> Column:
        return F.struct(of["namespace"].alias("namespace"), of["path"].alias("path"))

    if op in ("IN", "NOT_IN"):
        listed = [identity(key(v).to_column()) for v in value if v is not None]
        inside = identity(left).isin(listed) if listed else F.lit(False)
        return left.isNotNull() & (inside if op == "IN" else ~inside)
    if value is None:
        return left.isNull() if op == "=" else left.isNotNull() & F.lit(op == "!=")
    if op in ("=", "!="):
        return left.isNotNull() & _COMPARE[op](identity(left), identity(key(value).to_column()))
    text = F.concat(key_ns_code(left), F.lit("\n"), key_path_text(left))
    return _COMPARE[op](text, F.lit(f"{key(value).ns_code}\n{value.path_text}"))


# VARIANT type words that hold numbers.
_NUMBER_WORDS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")


def _variant_in(left: Column, name: str, values: Sequence[Any]) -> Column:
    """Lists of one type are one set lookup, so the length of a list does not matter."""
    word = F.regexp_extract(F.schema_of_variant(left), "^([A-Z_]+)", 1)
    texts = [v for v in values if isinstance(v, str)]
    flags = [v for v in values if isinstance(v, bool)]
    numbers = [v for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    other = [v for v in values if v is not None and not isinstance(v, (str, bool, int, float))]
    if other:
        raise QueryValidationError(f"cannot compare a mixed property with {other[0]!r}")
    def held(kind: str, listed: Sequence[Any]) -> Column:
        got = F.try_variant_get(left, "$", kind)
        return _isin(got, f"try_variant_get({_name(name)}, '$', '{kind}')", listed)

    found = []
    if len(values) > len(texts) + len(flags) + len(numbers):
        found.append(F.is_variant_null(left))
    if texts:
        found.append((word == "STRING") & held("string", texts))
    if flags:
        found.append((word == "BOOLEAN") & held("boolean", flags))
    if numbers:
        whole = held("bigint", [int(v) for v in numbers if float(v).is_integer()])
        fraction = held("double", [float(v) for v in numbers])
        found.append(F.when(word == "BIGINT", whole).when(word.isin(*_NUMBER_WORDS), fraction))
    return reduce(Column.__or__, [F.coalesce(f, F.lit(False)) for f in found]) if found else F.lit(False)


def _variant_condition(left: Column, name: str, op: str, value: Any) -> Column:
    """A mixed property only matches where it holds the type of the given value."""
    if op in ("IN", "NOT_IN"):
        inside = F.coalesce(_variant_in(left, name, value), F.lit(False))
        return inside if op == "IN" else left.isNotNull() & ~inside
    if value is None:
        return F.is_variant_null(left) if op == "=" else ~F.is_variant_null(left)
    word = F.regexp_extract(F.schema_of_variant(left), "^([A-Z_]+)", 1)
    compare, right = _COMPARE[op], F.lit(value)
    if isinstance(value, bool):
        return F.when(word == "BOOLEAN", compare(F.try_variant_get(left, "$", "boolean"), right))
    if isinstance(value, str):
        return F.when(word == "STRING", compare(F.try_variant_get(left, "$", "string"), right))
    if isinstance(value, (int, float)):
        whole = compare(F.try_variant_get(left, "$", "bigint"), right)
        fraction = compare(F.try_variant_get(left, "$", "double"), right)
        return F.when(word == "BIGINT", whole).when(word.isin(*_NUMBER_WORDS), fraction)
    raise QueryValidationError(f"cannot compare a mixed property with {value!r}")


def sort_columns(order: Sequence[str], df: DataFrame) -> list[Column]:
    """Sort columns of an order over `df`, then key order; names that `df` lacks are left out."""
    fields = field_types(df)
    return [*[_sort_column(i) for i in order if _split_order(i)[0] in fields], *_key_order(fields)]


def page_end(spec: QuerySpec, df: DataFrame, limit: int) -> PagePosition | None:
    """Where a page of `limit` rows ends that starts behind `spec.after`; None if there is no row.

    Only the properties of the order and the key are read, and only rows behind the start sorted.
    """
    fields = field_types(df)
    held = [name for name, _ in map(_split_order, spec.order) if name in fields]
    given = [F.unix_micros(column(n)) if isinstance(fields[n], T.TimestampType) else column(n) for n in held]
    marks = [F.struct(F.lit(0).alias("none"), *[v.alias(f"v{i}") for i, v in enumerate(given)]).alias("__values__")]
    ahead = spec.matching(df).select(*[column(n) for n in dict.fromkeys(held)], fv.NS, fv.PATH, *marks)
    sort = sort_columns(spec.order, df)
    turned = [_sort_column(i, turned=True) for i in spec.order if _split_order(i)[0] in fields]
    page = ahead.orderBy(*sort).limit(limit)
    # The last row of the page, without bringing the page to the driver.
    last = page.orderBy(*turned, F.col(fv.NS).desc(), F.col(fv.PATH).desc()).limit(1).collect()
    if not last:
        return None
    found = dict(zip(held, last[0]["__values__"][1:], strict=True))
    values = tuple(found.get(name) for name, _ in map(_split_order, spec.order))
    return PagePosition(last[0][fv.NS], last[0][fv.PATH], tuple(spec.order), values)


def _sort_column(item: str, turned: bool = False) -> Column:
    name, descending = _split_order(item)
    return column(name).desc() if descending != turned else column(name).asc()


def _key_order(fields: dict[str, T.DataType]) -> list[Column]:
    return [F.col(n) for n in (fv.NS, fv.PATH) if n in fields]
