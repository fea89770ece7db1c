"""Small files that are created once and never changed, on any file system Spark can reach."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _target(spark, path)
    return files.exists(target)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it does not exist."""
    files, target = _target(spark, folder)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _target(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False if somebody else has created it.

    A distributed file system does that itself.  On a local disk a link to a finished file
    does: making a link fails if its name is taken.
    """
    files, target = _target(spark, path)
    files.mkdirs(target.getParent())
    if files.getScheme() == "file":
        local = spark._jvm.java.nio.file
        name = target.toUri().getPath()
        draft = local.Path.of(f"{name}.{uuid.uuid4().hex}", spark.sparkContext._gateway.new_array(spark._jvm.String, 0))
        local.Files.writeString(draft, text, spark.sparkContext._gateway.new_array(local.OpenOption, 0))
        try:
            local.Files.createLink(local.Path.of(name, spark.sparkContext._gateway.new_array(spark._jvm.String, 0)), draft)
        except Py4JJavaError as problem:
            if "FileAlreadyExistsException" not in str(problem.java_exception):
                raise
            return False
        finally:
            local.Files.deleteIfExists(draft)
        return True
    try:
        stream = files.create(target, False)
    except Py4JJavaError as problem:
        if "AlreadyExists" not in str(problem.java_exception):
            raise
        return False
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
