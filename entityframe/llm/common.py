"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import importlib
import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import entityframe
from entityframe.sources.staging import fresh_path, stage

__all__ = ["fresh_path", "held_out", "load", "ship", "slices", "stage", "text_or_empty", "uniform"]

_SHIPPED: set[str] = set()


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Makes the library importable in Python workers, once per application.

    Spark itself hands the archive to executors; nothing has to be installed there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(entityframe.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="entityframe-py-"), "entityframe.zip")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as files:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    files.write(path, os.path.join("entityframe", os.path.relpath(path, root)))
    with open(archive, "wb") as out:
        out.write(buffer.getvalue())
    spark.sparkContext.addPyFile(archive)
    importlib.invalidate_caches()
    _SHIPPED.add(app)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few texts as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    # Workers stay for later tasks; what Arrow keeps of the batches goes back to the system.
    pa.default_memory_pool().release_unused()


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(name: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves `part` when divided by `parts`; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % parts == part, F.lit(False))


def uniform(salt: str, name: str) -> Column:
    """A repeatable number strictly between 0 and 1 for each id, from 48 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(name).cast("string"), F.lit(""))).cast("binary"))
    whole = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return (whole + F.lit(0.5)) / F.lit(float(1 << 48))
