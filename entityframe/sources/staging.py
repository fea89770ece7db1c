"""Shared scratch space for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from entityframe import fixed_values as fv
from entityframe.errors import SchemaError

#: A staged table is read again by as many tasks as it has row groups, also where one task wrote it.
ROW_GROUP_BYTES = 8 << 20
#: Larger methods are never compiled by the JVM: rows cost several times as much from there on.
_METHOD_LIMIT, _METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000

#: Key paths hardly repeat; a dictionary of them is built and thrown away for each row group.
NO_DICTIONARY = {f"parquet.enable.dictionary#{fv.PATH}": "false"}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Where that is unset, a `local` session, whose executors are this process, gets a temporary
    folder; on a cluster it would not be shared, so there the setting is asked for.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise SchemaError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="entityframe-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# Staged tables that have not been released, oldest first, by application and thread.
_WRITTEN: dict[tuple[str, int], list[str]] = {}


def _owner(spark: SparkSession) -> tuple[str, int]:
    return spark.sparkContext.applicationId, threading.get_ident()


def staged_count(spark: SparkSession) -> int:
    """How many tables this thread has staged; a place to give to `release`."""
    return len(_WRITTEN.get(_owner(spark), ()))


def release(spark: SparkSession, since: int = 0, newest: int = 0) -> int:
    """Delete the tables that this thread staged from place `since` on, but for the `newest` ones; returns how many.

    Frames that still read them, such as the results of a report, must not be used afterwards.
    """
    written = _WRITTEN.get(_owner(spark), [])
    gone = written[since : len(written) - newest]
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del written[since : len(written) - newest]
    return len(gone)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Rows of many fields make one generated method that the JVM would interpret; such a step then
    runs as several smaller ones, which it compiles."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, str(min(int(before), _METHOD_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


#: A task of a merge holds what it reads until it is dealt to the others, so it reads this much at most.
_SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in pieces of `SPLIT_BYTES`, so that what a map task buffers for the shuffle does
    not grow with the tables up to Spark's larger split."""
    before = spark.conf.get(_SPLIT)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > SPLIT_BYTES:
        spark.conf.set(_SPLIT, str(SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def stage(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write `df` once and read it back.

    The table cuts the lineage, survives the loss of executors and gives every later
    pass the same rows, also when the input is not deterministic.  `options` are those of Spark's
    Parquet writer.
    """
    path = fresh_path(df.sparkSession, label)
    _WRITTEN.setdefault(_owner(df.sparkSession), []).append(path)
    with compiled(df.sparkSession):
        df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).options(**NO_DICTIONARY, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
