"""Schemas: declared properties, key recipe, and the columns they compile to."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, datetime
from decimal import Decimal
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions.convert import Converted, is_missing, no_error
from entityframe.functions.keys import (
    KEY_TYPE,
    EntityKey,
    KeyColumns,
    KeySpec,
    key_error,
    key_is_complete,
    parse_key_json,
)
from entityframe.functions.logical import LogicalType, is_key_type, require_logical, same_type

UNSET = object()


def column(name: str) -> Column:
    """Column by exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def field_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


@dataclass(frozen=True)
class PerRow:
    """A default that is made anew for every cell it fills; see `per_row`."""

    make: Callable[[], Any]

    def column(self, missing: Column, dtype: T.DataType) -> Column:
        """Calls the function where `missing` holds, in Arrow batches, and never twice for a cell
        of one evaluation: Spark neither repeats nor moves a non-deterministic function."""
        make = self.make

        # Workers get this function by value: it uses nothing of this library.
        def fill(wanted: bool) -> Any:
            value = make() if wanted else None
            return getattr(value, "struct", value)

        return F.udf(fill, dtype, useArrow=True).asNondeterministic()(missing)


def per_row(make: Callable[[], Any]) -> PerRow:
    """A default for `Field` that calls a Python function for each missing cell, such as a fresh
    identifier.  The function is sent to the tasks; what it returns must fit the property's type
    as it is stored: a text for a string, a `datetime` for a timestamp, an `EntityKey` for a key.
    """
    return PerRow(make)


@dataclass(frozen=True)
class EncodedField:
    """Compiled property: stored value, is-it-stored flag and row error."""

    name: str
    value: Column
    present: Column
    error: Column
    indexed: bool


@dataclass(frozen=True)
class Field:
    """One declared property.

    `default` is a literal, a `Column`, a zero-argument function called once per job, or
    `per_row` of one, which is called for every missing cell.  `missing_policy` says what a missing cell without a default becomes:
    "omit" (not stored), "null" (stored null) or "error".
    """

    dtype: LogicalType
    nullable: bool = True
    indexed: bool = True
    default: Any = UNSET
    missing_policy: str = "omit"

    def __post_init__(self) -> None:
        require_logical(self.dtype)
        if self.missing_policy not in fv.MISSING_POLICIES:
            raise SchemaError(f"unknown missing policy: {self.missing_policy!r}")
        if self.default is None:
            raise SchemaError("a default must be a value; use missing_policy='null' for nulls")

    def encode(self, name: str, raw: Column, source: T.DataType, made: Column | None = None) -> EncodedField:
        """`made` holds what a `per_row` default has come to."""
        missing = is_missing(raw, source)
        given = self._converted(raw, source)
        required = F.lit(f"required property {name} ({self.dtype.name}) is missing")
        if self.default is not UNSET:
            filler = self._default(made)
            value = F.when(missing, filler.value).otherwise(given.value)
            error = F.when(missing, filler.error).otherwise(given.error)
            present = F.lit(True)
        elif self.missing_policy == "error" or not self.nullable:
            value = F.when(~missing, given.value)
            error = F.when(missing, required).otherwise(given.error)
            present = F.lit(True)
        else:
            value = F.when(~missing, given.value)
            error = F.when(~missing, given.error)
            present = F.lit(True) if self.missing_policy == "null" else ~missing
        return EncodedField(name, value.cast(self.dtype.spark_type), present, error, self.indexed)

    def decode(self, raw: Column, source: T.DataType) -> Column:
        if same_type(source, self.dtype.spark_type):
            return raw
        return F.when(raw.isNotNull(), self.dtype.decode(raw, source))

    def _converted(self, raw: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.NullType):
            return Converted(F.lit(None).cast(self.dtype.spark_type), no_error())
        made = self.dtype.encode(raw, source)
        too_long = self.dtype.index_error(made.value) if self.indexed else None
        if too_long is None:
            return made
        return Converted(made.value, F.coalesce(made.error, too_long))

    def _default(self, made: Column | None) -> Converted:
        if made is not None:
            too_long = self.dtype.index_error(made) if self.indexed else None
            return Converted(made, no_error() if too_long is None else too_long)
        value = self.default() if callable(self.default) and not isinstance(
            self.default, Column
        ) else self.default
        if isinstance(value, EntityKey):
            return Converted(value.to_column(), no_error())
        if isinstance(value, Column):
            return Converted(value.cast(self.dtype.spark_type), no_error())
        literal, dtype = F.lit(value), _literal_type(value)
        return self._converted(literal, dtype)


# Spark types of plain Python values; a bool is also an int, so it comes first.
_LITERAL_TYPES = (
    (bool, T.BooleanType()),
    (int, T.LongType()),
    (float, T.DoubleType()),
    (str, T.StringType()),
    ((bytes, bytearray), T.BinaryType()),
    (datetime, T.TimestampType()),
    (date, T.DateType()),
    (Decimal, T.DecimalType(38, 18)),
)


def _literal_type(value: Any) -> T.DataType:
    for kinds, dtype in _LITERAL_TYPES:
        if isinstance(value, kinds):
            return dtype
    if isinstance(value, (list, tuple)) and value:
        return T.ArrayType(_literal_type(value[0]))
    raise SchemaError(f"not a default value: {value!r}")


@dataclass(frozen=True)
class Schema:
    """Contract of one kind.

    Writes are checked against it; with `strict` a column that is not declared must
    be empty on write and is left out on read.
    """

    kind: str
    properties: Mapping[str, Field] = field(default_factory=dict)
    key: KeySpec | None = None
    strict: bool = True

    def __post_init__(self) -> None:
        if "" in self.properties:
            raise SchemaError("a property needs a name")
        clash = sorted(set(self.properties) & set(fv.SYSTEM_COLUMNS))
        if clash:
            raise SchemaError(f"reserved property names: {', '.join(clash)}")

    def with_kind(self, kind: str) -> Schema:
        """Same contract under another kind; the leaf of the key path follows."""
        key = None if self.key is None else self.key.with_leaf_kind(kind)
        return replace(self, kind=kind, key=key)

    def row_defaults(self, names: Sequence[str] | None = None) -> dict[str, Field]:
        """The named (or all) properties whose default is made for every row."""
        chosen = self.properties if names is None else names
        found = {n: self.properties[n] for n in chosen if n in self.properties}
        return {n: f for n, f in found.items() if isinstance(f.default, PerRow)}

    def with_row_defaults(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """`df` with a column for each default made per row, so that whatever is worked out from
        one is worked out from the same value."""
        fields = field_types(df)
        made = {}
        for name, of in self.row_defaults(names).items():
            missing = is_missing(column(name), fields[name]) if name in fields else F.lit(True)
            made[_made(name)] = of.default.column(missing, of.dtype.spark_type)
        return df.withColumns(made) if made else df

    def to_struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, f.dtype.spark_type) for n, f in self.properties.items()]
        )

    # --- row checks ---

    def required_error(self, df: DataFrame) -> Column:
        """All missing required names of a row in one message."""
        fields = field_types(df)
        checks = [
            F.when(
                is_missing(column(n), fields[n]) if n in fields else F.lit(True), F.lit(n)
            )
            for n, f in self.properties.items()
            if not f.nullable
        ]
        return _named_error("missing required fields: ", checks)

    def unknown_error(self, df: DataFrame, aside: Sequence[str | None] = ()) -> Column:
        """Undeclared columns that hold a value, names sorted (strict schemas only).

        Columns named in `aside` are the caller's own."""
        if not self.strict:
            return no_error()
        known = set(self.properties) | {fv.KEY, *aside}
        known |= set() if self.key is None else self.key.sources
        checks = [
            F.when(~is_missing(column(n), t), F.lit(n))
            for n, t in sorted(field_types(df).items())
            if n not in known
        ]
        return _named_error("unknown fields for strict schema: ", checks)

    # --- compiled columns ---

    def encode(
        self, df: DataFrame, properties: Sequence[str] | None = None
    ) -> tuple[list[EncodedField], Column]:
        """Encoded properties in order, plus an error for names that are not declared.

        `properties=None` takes every declared name, an empty list takes none.
        """
        fields = field_types(df)
        names = list(self.properties) if properties is None else list(dict.fromkeys(properties))
        unknown = [n for n in names if n not in self.properties]
        error = no_error()
        if unknown and self.strict:
            error = F.lit(f"property {unknown[0]} is not declared in schema {self.kind}")
        made = []
        for name in names:
            if name not in self.properties:
                continue
            raw = column(name) if name in fields else F.lit(None).cast("string")
            source = fields.get(name, T.NullType())
            filler = column(_made(name)) if _made(name) in fields else None
            made.append(self.properties[name].encode(name, raw, source, filler))
        return made, error

    def key_columns(self, df: DataFrame) -> KeyColumns:
        """Keys of every row: `__key__` where present, else from the recipe."""
        fields = field_types(df)
        if fv.KEY not in fields:
            if self.key is None:
                raise SchemaError("no key recipe in the schema and no __key__ column")
            return self.key.build(fields)
        raw, source = F.col(fv.KEY), fields[fv.KEY]
        if is_key_type(source):
            own = KeyColumns.of(raw, key_error(raw))
        elif isinstance(source, T.StringType):
            parsed = parse_key_json(raw)
            own = KeyColumns.of(parsed.value, parsed.error)
        elif isinstance(source, T.NullType):
            own = KeyColumns.of(F.lit(None).cast(KEY_TYPE), no_error())
        else:
            raise SchemaError(f"__key__ must be a key struct or JSON text, not {source}")
        if self.key is None:
            missing = F.when(raw.isNull(), F.lit("no key recipe in the schema and __key__ is missing"))
            return replace(own, error=F.coalesce(own.error, missing))
        spec, given = self.key.build(fields), raw.isNotNull()

        def choose(name: str) -> Column:
            return F.when(given, getattr(own, name)).otherwise(getattr(spec, name))

        return KeyColumns(*[choose(n) for n in ("value", "error", "ns", "path")])

    def decode(self, df: DataFrame, *, include_key: bool = False) -> DataFrame:
        """User-facing frame of a raw entity frame."""
        fields = field_types(df)
        kept = []
        for name, source in fields.items():
            if name in self.properties:
                kept.append(self.properties[name].decode(column(name), source).alias(name))
            elif not self.strict and name not in fv.SYSTEM_COLUMNS:
                kept.append(column(name))
        if include_key and fv.KEY in fields:
            kept.append(F.col(fv.KEY))
        return df.select(*kept)


def _made(name: str) -> str:
    return f"__made_{name}__"


def incomplete_error(key: Column, operation: str) -> Column:
    return F.when(~key_is_complete(key), F.lit(f"{operation} needs complete keys"))


def _named_error(prefix: str, checks: list[Column]) -> Column:
    if not checks:
        return no_error()
    names = F.concat_ws(", ", *checks)
    return F.when(names != "", F.concat(F.lit(prefix), names))
