"""Group-by with one metric per column, over data with missing values."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError
from entityframe.functions.convert import is_missing, nan_to_null
from entityframe.schema import column, field_types


def aggregate(df: DataFrame, by: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """One row per combination of `by`, with `<column>_<metric>` columns.

    Missing cells (NULL, NaN) are skipped, NULL is a group of its own, and the sum of
    nothing is 0.
    """
    if not by:
        raise SchemaError("aggregate needs at least one grouping column")
    if not metrics:
        raise SchemaError("aggregate needs at least one metric")
    unknown = sorted(set(metrics.values()) - set(fv.METRICS))
    if unknown:
        raise SchemaError(f"unknown metric: {', '.join(unknown)}")
    fields = field_types(df)
    absent = sorted((set(by) | set(metrics)) - set(fields))
    if absent:
        raise SchemaError(f"no such column: {', '.join(absent)}")
    made = [
        metric(name, kind, fields[name]).alias(f"{name}_{kind}") for name, kind in metrics.items()
    ]
    return df.groupBy(*[column(n) for n in by]).agg(*made)


def metric(name: str, kind: str, dtype: T.DataType) -> Column:
    raw = column(name)
    if kind == "count":
        return F.count_if(~is_missing(raw, dtype))
    value = nan_to_null(raw, dtype)
    if kind == "min":
        return F.min(value)
    if kind == "max":
        return F.max(value)
    if isinstance(dtype, T.BooleanType):
        value = value.cast("bigint")
    elif not isinstance(dtype, T.NumericType):
        raise SchemaError(f"{kind} needs a numeric column, {name} is {dtype.simpleString()}")
    if kind == "mean":
        return F.avg(value)
    return F.coalesce(F.sum(value), F.lit(0).cast(value_type(dtype)))


def value_type(dtype: T.DataType) -> T.DataType:
    """Type of an empty sum."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(dtype.precision + 10, 38), dtype.scale)
    return T.LongType()


def summarize(
    df: DataFrame,
    by: Sequence[str],
    *,
    first: Mapping[str, str] | None = None,
    order: str | None = None,
    count: Mapping[str, str] | None = None,
    mean: Mapping[str, str] | None = None,
) -> DataFrame:
    """Mixed summary: output name -> column for each kind of metric.

    `first` takes the first non-missing value in the order of column `order`, which
    keeps the result the same from run to run.
    """
    fields = field_types(df)
    made = []
    for output, name in (first or {}).items():
        if order is None:
            raise SchemaError("first needs an order column")
        filled = ~is_missing(column(name), fields[name])
        made.append(F.min_by(column(name), F.when(filled, column(order))).alias(output))
    made += [metric(n, "count", fields[n]).alias(o) for o, n in (count or {}).items()]
    made += [metric(n, "mean", fields[n]).alias(o) for o, n in (mean or {}).items()]
    return df.groupBy(*[column(n) for n in by]).agg(*made)


def busiest(df: DataFrame, measure: str, *, ties: Sequence[str] = (), n: int = 1) -> DataFrame:
    """The n rows with the largest measure (a top-k report)."""
    return df.orderBy(column(measure).desc(), *[column(t) for t in ties]).limit(n)
