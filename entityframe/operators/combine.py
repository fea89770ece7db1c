"""Concatenation of sparse frames by column name."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions.convert import is_fractional, is_integral
from entityframe.functions.logical import as_variant, same_type
from entityframe.schema import column, field_types


def concat(frames: Sequence[DataFrame], *, mixed_type_policy: str = "object") -> DataFrame:
    """Union by name; a column a frame lacks is NULL there.

    Columns of different type are brought to a common one: whole numbers widen, whole
    and fractional numbers become float64, anything else follows the policy.
    """
    if not frames:
        raise SchemaError("concat needs at least one frame")
    if mixed_type_policy not in fv.MIXED_TYPE_POLICIES:
        raise SchemaError(f"unknown mixed type policy: {mixed_type_policy!r}")
    seen: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for name, dtype in field_types(frame).items():
            seen.setdefault(name, []).append(dtype)
    target = {name: common_type(name, types, mixed_type_policy) for name, types in seen.items()}
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [_cast_frame(f, target) for f in frames],
    )


def common_type(name: str, types: Sequence[T.DataType], policy: str = "object") -> T.DataType:
    real = [t for t in types if not isinstance(t, T.NullType)]
    if not real:
        return T.StringType()
    if all(same_type(t, real[0]) for t in real):
        return real[0]
    if all(is_integral(t) for t in real):
        return T.LongType()
    if all(is_integral(t) or is_fractional(t) for t in real):
        return T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in real):
        return T.TimestampType()
    if policy == "string":
        return T.StringType()
    if policy == "object":
        return T.VariantType()
    raise SchemaError(
        f"column {name} has mixed types: " + ", ".join(sorted({t.simpleString() for t in real}))
    )


def _cast_frame(df: DataFrame, target: dict[str, T.DataType]) -> DataFrame:
    made = []
    for name, source in field_types(df).items():
        wanted = target[name]
        if same_type(source, wanted):
            made.append(column(name))
        elif isinstance(wanted, T.VariantType):
            made.append(as_variant(column(name), source).alias(name))
        elif isinstance(wanted, T.StringType) and isinstance(
            source, (T.StructType, T.ArrayType, T.MapType)
        ):
            made.append(F.to_json(column(name)).alias(name))
        else:
            made.append(column(name).cast(wanted).alias(name))
    return df.select(*made)
