"""Logical property types.

Each type compiles a source column of any Spark type to the stored column
(`encode`), turns a stored column back (`decode`) and names what is wrong with an
indexed value (`index_error`).  Everything is a `Column` expression.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions import convert
from entityframe.functions.convert import Converted
from entityframe.functions.keys import KEY_TYPE, key_error, parse_key_json

GEO_TYPE = T.StructType(
    [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
)


class LogicalType:
    """Base of all logical types."""

    name = "object"

    @property
    def spark_type(self) -> T.DataType:
        raise NotImplementedError

    def encode(self, col: Column, source: T.DataType) -> Converted:
        raise NotImplementedError

    def decode(self, col: Column, source: T.DataType) -> Column:
        return col if same_type(source, self.spark_type) else self.encode(col, source).value

    def index_error(self, value: Column) -> Column | None:
        return None

    def encode_null_item(self) -> Column | None:
        """What a NULL array item becomes; None means it is an error."""
        return None


class ObjectType(LogicalType):
    """Pass-through: any value, kept as VARIANT so that rows may differ in type."""

    @property
    def spark_type(self) -> T.DataType:
        return T.VariantType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        return Converted(as_variant(col, source), convert.no_error())

    def encode_null_item(self) -> Column | None:
        return F.lit(None).cast(self.spark_type)


class Int64Type(LogicalType):
    name = "int64"

    @property
    def spark_type(self) -> T.DataType:
        return T.LongType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        return convert.to_int64(col, source)


class Float64Type(LogicalType):
    name = "float64"

    @property
    def spark_type(self) -> T.DataType:
        return T.DoubleType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        return convert.to_float64(col, source)


class BoolType(LogicalType):
    """Known spellings first, otherwise "is it empty or zero" decides."""

    name = "bool"

    @property
    def spark_type(self) -> T.DataType:
        return T.BooleanType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.BooleanType):
            value = col
        elif convert.is_integral(source) or convert.is_fractional(source):
            value = col != F.lit(0)
        elif isinstance(source, T.StringType):
            word = F.lower(convert.strip(col))
            value = (
                F.when(word.isin(*fv.TRUE_WORDS), True)
                .when(word.isin(*fv.FALSE_WORDS), False)
                .otherwise(F.length(col) > 0)
            )
        elif isinstance(source, (T.ArrayType, T.MapType)):
            value = F.size(col) > 0
        elif isinstance(source, T.BinaryType):
            value = F.octet_length(col) > 0
        else:
            value = col.isNotNull()
        return Converted(value, convert.no_error())

    def encode_null_item(self) -> Column | None:
        return F.lit(False)


class StringType(LogicalType):
    name = "string"

    @property
    def spark_type(self) -> T.DataType:
        return T.StringType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return Converted(F.to_json(col), convert.no_error())
        return Converted(col.cast("string"), convert.no_error())

    def index_error(self, value: Column) -> Column | None:
        return F.when(
            F.octet_length(value) > fv.INDEXED_BYTES_LIMIT,
            F.lit(f"indexed string exceeds {fv.INDEXED_BYTES_LIMIT} bytes"),
        )

    def encode_null_item(self) -> Column | None:
        return F.lit("None")


class BlobType(LogicalType):
    name = "blob"

    @property
    def spark_type(self) -> T.DataType:
        return T.BinaryType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.BinaryType):
            return Converted(col, convert.no_error())
        return convert.unsupported("blob", source, self.spark_type)

    def index_error(self, value: Column) -> Column | None:
        return F.when(
            F.octet_length(value) > fv.INDEXED_BYTES_LIMIT,
            F.lit(f"indexed blob exceeds {fv.INDEXED_BYTES_LIMIT} bytes"),
        )


@dataclass(frozen=True)
class TimestampType(LogicalType):
    """UTC instants with microseconds; the session time zone must be UTC.

    Values without a zone are taken to be in `assume_timezone`.  Whole numbers are
    nanoseconds since the epoch when written and microseconds when read back.
    """

    assume_timezone: str = "UTC"
    name = "timestamp"

    @property
    def spark_type(self) -> T.DataType:
        return T.TimestampType()

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.TimestampType):
            return Converted(col, convert.no_error())
        if isinstance(source, (T.TimestampNTZType, T.DateType)):
            return Converted(self._localize(col.cast("timestamp")), convert.no_error())
        if isinstance(source, T.StringType):
            has_zone = col.rlike(r"(?i)([zZ]|[+-][0-9]{2}:?[0-9]{2}|utc|gmt)\s*$")
            parsed = F.try_to_timestamp(col)
            value = F.when(has_zone, parsed).otherwise(self._localize(parsed))
            return convert.checked(value, col, "timestamp")
        if convert.is_integral(source):
            nanos = col.cast("bigint")
            whole = F.timestamp_micros(_floor_div(nanos, 1000))
            return Converted(self._localize(whole), convert.no_error())
        return convert.unsupported("timestamp", source, self.spark_type)

    def decode(self, col: Column, source: T.DataType) -> Column:
        if isinstance(source, T.TimestampType):
            return col
        if convert.is_integral(source):
            return F.timestamp_micros(col.cast("bigint"))
        if isinstance(source, (T.TimestampNTZType, T.DateType)):
            return col.cast("timestamp")
        return F.try_to_timestamp(col.cast("string"))

    def _localize(self, col: Column) -> Column:
        if self.assume_timezone.upper() == "UTC":
            return col
        return F.to_utc_timestamp(col, self.assume_timezone)


class KeyType(LogicalType):
    """A key held as a property: key struct or key JSON text."""

    name = "key"

    @property
    def spark_type(self) -> T.DataType:
        return KEY_TYPE

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.StringType):
            return parse_key_json(col)
        if is_key_type(source):
            typed = col.cast(KEY_TYPE)
            return Converted(typed, key_error(typed))
        return convert.unsupported("key", source, KEY_TYPE)


class GeoPointType(LogicalType):
    name = "geo_point"

    @property
    def spark_type(self) -> T.DataType:
        return GEO_TYPE

    def encode(self, col: Column, source: T.DataType) -> Converted:
        picked = self._pick(col, source)
        if picked is None:
            return convert.unsupported("geo_point", source, GEO_TYPE)
        latitude, longitude = picked
        error = F.coalesce(
            F.when(
                latitude.isNull() | longitude.isNull(),
                F.lit("a geo point needs a numeric latitude and longitude"),
            ),
            _range_error(latitude, "latitude", fv.LATITUDE_RANGE),
            _range_error(longitude, "longitude", fv.LONGITUDE_RANGE),
        )
        point = F.struct(latitude.alias("latitude"), longitude.alias("longitude"))
        return Converted(F.when(error.isNull(), point), error)

    @staticmethod
    def _pick(col: Column, source: T.DataType) -> tuple[Column, Column] | None:
        if isinstance(source, T.StructType):
            names = {f.name: f.dataType for f in source.fields}
            if {"latitude", "longitude"} <= set(names):
                return tuple(
                    convert.to_float64(col[n], names[n]).value for n in ("latitude", "longitude")
                )
        elif isinstance(source, T.MapType):
            return tuple(
                convert.to_float64(F.element_at(col, n), source.valueType).value
                for n in ("latitude", "longitude")
            )
        elif isinstance(source, T.ArrayType):
            return tuple(
                convert.to_float64(F.get(col, F.lit(i)), source.elementType).value for i in (0, 1)
            )
        return None


@dataclass(frozen=True)
class ArrayType(LogicalType):
    """List of items of one logical type; lists inside lists are rejected."""

    item_type: LogicalType = field(default_factory=ObjectType)
    name = "array"

    @property
    def spark_type(self) -> T.DataType:
        return T.ArrayType(self.item_type.spark_type)

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if not isinstance(source, T.ArrayType):
            return convert.unsupported("array", source, self.spark_type)
        if isinstance(source.elementType, T.ArrayType):
            # An empty outer list is still fine; only an inner list is wrong.
            error = F.when(
                F.exists(col, lambda x: x.isNotNull()), F.lit("arrays cannot contain arrays")
            )
            return Converted(F.array().cast(self.spark_type), error)
        null_item = self.item_type.encode_null_item()

        def item(x: Column) -> Converted:
            made = self.item_type.encode(x, source.elementType)
            lost = convert.is_missing(x, source.elementType) if null_item is None else x.isNull()
            if null_item is None:
                return Converted(
                    made.value,
                    F.when(lost, F.lit(f"missing {self.item_type.name} array item")).otherwise(
                        made.error
                    ),
                )
            return Converted(
                F.when(lost, null_item).otherwise(made.value),
                F.when(~lost, made.error),
            )

        value = F.transform(col, lambda x: item(x).value)
        error = _first_text(F.transform(col, lambda x: item(x).error))
        return Converted(value, error)

    def decode(self, col: Column, source: T.DataType) -> Column:
        if same_type(source, self.spark_type):
            return col
        if not isinstance(source, T.ArrayType):
            return self.encode(col, source).value
        return F.transform(col, lambda x: self.item_type.decode(x, source.elementType))

    def index_error(self, value: Column) -> Column | None:
        sample = self.item_type.index_error(F.lit(None).cast(self.item_type.spark_type))
        if sample is None:
            return None
        return _first_text(F.transform(value, lambda x: self.item_type.index_error(x)))


@dataclass(frozen=True)
class EmbeddedEntityType(LogicalType):
    """A nested record: a struct when the shape is declared, VARIANT otherwise."""

    shape: T.StructType | None = None
    name = "entity"

    @property
    def spark_type(self) -> T.DataType:
        return T.VariantType() if self.shape is None else self.shape

    def encode(self, col: Column, source: T.DataType) -> Converted:
        if isinstance(source, T.VariantType):
            is_object = F.startswith(F.schema_of_variant(col), F.lit("OBJECT"))
            error = F.when(~is_object, F.lit("an embedded entity must be an object"))
            value = col if self.shape is None else F.try_variant_get(col, "$", _ddl(self.shape))
            return Converted(F.when(is_object, value), error)
        if isinstance(source, T.StructType):
            if self.shape is None:
                return Converted(F.to_variant_object(col), convert.no_error())
            names = {f.name: f.dataType for f in source.fields}
            parts = [
                (col[f.name] if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.shape.fields
            ]
            return Converted(F.when(col.isNotNull(), F.struct(*parts)), convert.no_error())
        if isinstance(source, T.MapType) and isinstance(source.keyType, T.StringType):
            if self.shape is None:
                return Converted(F.to_variant_object(col), convert.no_error())
            parts = [
                F.element_at(col, f.name).cast(f.dataType).alias(f.name)
                for f in self.shape.fields
            ]
            return Converted(F.when(col.isNotNull(), F.struct(*parts)), convert.no_error())
        return convert.unsupported("embedded entity", source, self.spark_type)


def as_variant(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.VariantType):
        return col
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(col)
    return col.cast("variant")


def comparable(col: Column, dtype: T.DataType) -> Column:
    """Form of a stored value that `=` and grouping accept.

    Native equality is right for scalars, structs and arrays.  VARIANT has none, so
    it goes through its canonical text (object names sorted); keys compare by
    namespace and path only.
    """
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    if is_key_type(dtype):
        return F.struct(col["namespace"].alias("namespace"), col["path"].alias("path"))
    if isinstance(dtype, T.ArrayType) and _holds_special(dtype.elementType):
        return F.transform(col, lambda x: comparable(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(col)))
    if isinstance(dtype, T.StructType) and any(_holds_special(f.dataType) for f in dtype.fields):
        parts = [comparable(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*parts))
    return col


def _hashed(col: Column, dtype: T.DataType, salt: int) -> Column:
    """64 bits that are equal for values that `comparable` makes equal.

    Spark's hash passes over nulls, so each level says where it has one.
    """
    if isinstance(dtype, (T.VariantType, T.MapType)):
        return F.xxhash64(F.lit(salt), col.isNull(), comparable(col, dtype))
    if isinstance(dtype, T.StructType):
        named = ("namespace", "path") if is_key_type(dtype) else dtype.names
        parts = [_hashed(col[f.name], f.dataType, salt) for f in dtype.fields if f.name in named]
        return F.xxhash64(F.lit(salt), col.isNull(), *parts)
    if isinstance(dtype, T.ArrayType):
        return F.xxhash64(F.lit(salt), col.isNull(), F.transform(col, lambda x: _hashed(x, dtype.elementType, salt)))
    return F.xxhash64(F.lit(salt), col.isNull(), col)


DIGEST_TYPE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def content_digest(held: dict[str, Column], values: dict[str, tuple[Column, T.DataType]]) -> Column:
    """128 bits over the names an entity stores (where `held`), and over their types and values.

    Names that are not stored are nulls, which the hash passes over: columns that a table gains
    later leave the digest of an entity without them as it is.
    """

    def half(side: str) -> Column:
        parts = []
        for name, (col, dtype) in sorted(values.items()):
            known = hashlib.sha256(f"{side} {dtype.simpleString()} {name}".encode()).digest()[:8]
            parts.append(F.when(held[name], _hashed(col, dtype, int.from_bytes(known, "big", signed=True))))
        return F.xxhash64(F.lit(side), *parts)

    return F.struct(half("a").alias("a"), half("b").alias("b"))


def _holds_special(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.VariantType, T.MapType)) or is_key_type(dtype):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_special(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_special(f.dataType) for f in dtype.fields)
    return False


def is_key_type(source: T.DataType) -> bool:
    return isinstance(source, T.StructType) and {f.name for f in source.fields} == {
        f.name for f in KEY_TYPE.fields
    }


def same_type(left: T.DataType, right: T.DataType) -> bool:
    """Equal up to nullability."""
    return left.simpleString() == right.simpleString()


def _floor_div(col: Column, divisor: int) -> Column:
    down = col - F.pmod(col, F.lit(divisor).cast("bigint"))
    return F.call_function("div", down, F.lit(divisor).cast("bigint"))


def _range_error(value: Column, label: str, limits: tuple[float, float]) -> Column:
    low, high = limits
    return F.when(
        ~value.between(F.lit(low), F.lit(high)),
        F.lit(f"{label} must be between {low:g} and {high:g}"),
    )


def _first_text(texts: Column) -> Column:
    return F.get(F.array_except(texts, F.array(F.lit(None).cast("string"))), F.lit(0))


def _ddl(shape: T.StructType) -> str:
    return shape.simpleString()


# Observed type name -> logical type.
LOGICAL_TYPES: dict[str, Callable[[], LogicalType]] = {
    "array": ArrayType,
    "blob": BlobType,
    "bool": BoolType,
    "embedded_entity": EmbeddedEntityType,
    "float64": Float64Type,
    "geo_point": GeoPointType,
    "int64": Int64Type,
    "key": KeyType,
    "string": StringType,
    "timestamp": TimestampType,
}


def logical_type_for(name: str) -> LogicalType:
    """Logical type of an observed type name; anything unknown passes through."""
    made = LOGICAL_TYPES.get(name)
    return ObjectType() if made is None else made()


def require_logical(value: object) -> LogicalType:
    if not isinstance(value, LogicalType):
        raise SchemaError(f"not a logical type: {value!r}")
    return value
