"""Chunk numbers and keyset pages over a large frame."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from entityframe import fixed_values as fv
from entityframe.errors import QueryValidationError
from entityframe.plans.query import PagePosition
from entityframe.sources.staging import stage

_PART, _AT = "__part__", "__at__"
# monotonically_increasing_id() keeps the partition number above these bits.
_ROW_BITS = 33


def _placed(
    df: DataFrame, order: Sequence[Column | str]
) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """The sorted frame, written once with each row's partition and place in it, and
    (partition, rows before it, rows in it) for every partition of the sort."""
    row_id = F.monotonically_increasing_id()
    placed = df.orderBy(*order).withColumn("__id__", row_id)
    placed = placed.withColumns(
        {
            _PART: F.shiftright("__id__", _ROW_BITS),
            _AT: F.col("__id__").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("__id__")
    stored = stage(placed, "numbered")
    # One row per task of the sort.
    sizes = stored.groupBy(_PART).agg((F.max(_AT) + 1).alias("rows")).orderBy(_PART).collect()
    parts, total = [], 0
    for row in sizes:
        parts.append((row[_PART], total, row["rows"]))
        total += row["rows"]
    return stored, parts


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "row_number") -> DataFrame:
    """Global row number from 0 in the given order, without a single-task window:
    a row's place in its partition plus the size of all partitions before it."""
    stored, parts = _placed(df, order)
    # Bounded by the number of tasks of the sort.
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for part, start, _ in parts], f"{_PART} bigint, __start__ bigint"
    )
    ranked = stored.join(F.broadcast(offsets), _PART)
    return ranked.withColumn(name, F.col("__start__") + F.col(_AT)).drop(_PART, _AT, "__start__")


def with_chunks(
    df: DataFrame, chunksize: int, order: Sequence[Column | str] = (fv.NS, fv.PATH)
) -> DataFrame:
    """Adds `chunk_number`: rows 0..n-1 of the order are chunk 0, and so on."""
    _check_size(chunksize)
    ranked = numbered(df, order, "__n__")
    chunk = F.call_function("div", F.col("__n__"), F.lit(chunksize).cast("bigint"))
    return ranked.withColumn("chunk_number", chunk).drop("__n__")


def iter_chunks(
    df: DataFrame, chunksize: int, order: Sequence[Column | str] = (fv.NS, fv.PATH)
) -> Iterator[DataFrame]:
    """One DataFrame per chunk, in order.

    A chunk is a few ranges of places, which Parquet statistics find in the sorted
    files; the other files are not read for it.
    """
    _check_size(chunksize)
    stored, parts = _placed(df, order)
    total = sum(rows for _, _, rows in parts)
    for first in range(0, total, chunksize):
        end = min(first + chunksize, total)
        ranges = [
            (F.col(_PART) == part)
            & F.col(_AT).between(max(first - start, 0), min(end - start, rows) - 1)
            for part, start, rows in parts
            if start < end and start + rows > first
        ]
        yield stored.filter(reduce(Column.__or__, ranges)).drop(_PART, _AT)


def _check_size(chunksize: int) -> None:
    if chunksize < 1:
        raise QueryValidationError("chunksize must be at least 1")


@dataclass(frozen=True)
class Page:
    """Rows of one keyset page and where the next one starts (None at the end)."""

    rows: DataFrame
    next: PagePosition | None

