"""CSV source and sink."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from entityframe.functions.text import lenient_bool
from entityframe.schema import column


def read_csv(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """Read with a fixed schema; blank is NULL, booleans accept the usual words."""
    as_text = {f.name for f in columns.fields if isinstance(f.dataType, T.BooleanType)}
    physical = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in as_text else f.dataType)
            for f in columns.fields
        ]
    )
    rows = spark.read.schema(physical).csv(path, header=True, nullValue="")
    return rows.select(
        *[
            lenient_bool(column(f.name)).alias(f.name) if f.name in as_text else column(f.name)
            for f in columns.fields
        ]
    )


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    picked = df if columns is None else df.select(*[column(c) for c in columns])
    picked.write.csv(path, header=True)
