"""Small files on the shared file system: markers, logs and listings, without a Spark job."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; a folder that does not exist holds nothing."""
    system, place = _place(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole, in place of one that is there."""
    system, place = _place(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole text, or return False if there is one by that name.

    Of several writers exactly one makes it, and a reader sees all of it or nothing: the text
    goes to a hidden file first. On a local file system that is linked to the name, elsewhere
    renamed without replacing, which HDFS does in one step.
    """
    system, place = _place(spark, path)
    if system.exists(place):
        return False
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    if system.getUri().getScheme() == "file":
        target, hidden = (unquote(urlparse(p).path) if p.startswith("file:") else p for p in (path, hidden))
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(hidden, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(hidden, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(hidden)
        return True
    write_text(spark, hidden, text)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        context.rename(hadoop.Path(hidden), place, options)
        return True
    except Py4JJavaError as error:
        system.delete(hadoop.Path(hidden), False)
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
