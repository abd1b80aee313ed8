"""Small text files beside tables, written and read through Hadoop's file systems.

A record of a load or a batch is a few hundred bytes.  Writing it as a Spark
table takes a job, a folder and a commit; this takes one call on the driver, on
any storage that Spark reaches.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name


def write_note(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Writes ``text``; without ``overwrite`` an existing file raises FileExistsError."""
    place, fs = _at(spark, path)
    try:
        out = fs.create(place, overwrite)
    except Py4JJavaError as e:
        if _is(e, "FileAlreadyExistsException"):
            raise FileExistsError(path) from None
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None if there is none."""
    place, fs = _at(spark, path)
    try:
        source = fs.open(place)
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def list_notes(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, sorted; none if it is not there."""
    place, fs = _at(spark, folder)
    try:
        found = fs.listStatus(place)
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return []
        raise
    return sorted(f.getPath().getName() for f in found)


def remove_note(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all that is in it, if it is there."""
    place, fs = _at(spark, path)
    fs.delete(place, True)
