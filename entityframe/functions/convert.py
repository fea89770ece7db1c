"""Column helpers shared by the type encoders and the key builders.

A conversion never raises inside a task.  It returns a pair of columns: the
converted value and an error text that is NULL when the value is fine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

_INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
_JAVA_FLOAT_SUFFIX = r"[0-9.][dDfF]\s*$"


@dataclass(frozen=True)
class Converted:
    """Value column plus error column of one conversion."""

    value: Column
    error: Column


def no_error() -> Column:
    return F.lit(None).cast("string")


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL)


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FRACTIONAL)


def is_missing(col: Column, dtype: T.DataType) -> Column:
    """NULL, or NaN for floating columns.  Containers are missing only when NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    if isinstance(dtype, T.VariantType):
        # A variant can hold an explicit null or a NaN inside.
        return col.isNull() | F.is_variant_null(col) | F.coalesce(
            F.isnan(F.try_variant_get(col, "$", "double")), F.lit(False)
        )
    return col.isNull()


def strip(text: Column) -> Column:
    """Trim all common white space, not just blanks."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def nan_to_null(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def unsupported(target: str, source: T.DataType, result_type: T.DataType) -> Converted:
    """Every non-missing value of this column type is an error."""
    return Converted(
        F.lit(None).cast(result_type),
        F.lit(f"cannot convert {source.simpleString()} to {target}"),
    )


def checked(value: Column, raw: Column, target: str) -> Converted:
    error = F.when(
        value.isNull(), F.concat(F.lit(f"cannot convert to {target}: "), raw.cast("string"))
    )
    return Converted(value, error)


def to_int64(col: Column, source: T.DataType) -> Converted:
    """Whole number; fractions are cut toward zero, int-like text is parsed."""
    if is_integral(source):
        return Converted(col.cast("bigint"), no_error())
    if is_fractional(source):
        return checked(col.try_cast("bigint"), col, "int64")
    if isinstance(source, T.StringType):
        digits = F.when(col.rlike(_INT_TEXT), F.replace(strip(col), F.lit("_"), F.lit("")))
        return checked(digits.try_cast("bigint"), col, "int64")
    if isinstance(source, T.VariantType):
        # A whole number or a fraction; text inside a variant follows the text rule.
        text = F.try_variant_get(col, "$", "string")
        number = F.coalesce(
            F.try_variant_get(col, "$", "bigint"),
            F.try_variant_get(col, "$", "double").try_cast("bigint"),
        )
        is_bool = F.schema_of_variant(col) == F.lit("BOOLEAN")
        return checked(F.when(~is_bool, number), text, "int64")
    if isinstance(source, T.BooleanType):
        return Converted(
            F.lit(None).cast("bigint"), F.lit("boolean values are not accepted as int64")
        )
    return unsupported("int64", source, T.LongType())


def to_float64(col: Column, source: T.DataType) -> Converted:
    if is_integral(source) or is_fractional(source) or isinstance(source, T.BooleanType):
        return Converted(col.cast("double"), no_error())
    if isinstance(source, T.StringType):
        plain = F.when(~col.rlike(_JAVA_FLOAT_SUFFIX), col)
        return checked(plain.try_cast("double"), col, "float64")
    if isinstance(source, T.VariantType):
        text = F.try_variant_get(col, "$", "string")
        return checked(F.try_variant_get(col, "$", "double"), text, "float64")
    return unsupported("float64", source, T.DoubleType())
