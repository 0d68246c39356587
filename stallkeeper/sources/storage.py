"""Paths on whatever file system they name: does something exist there, and remove it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _at(spark, path)
    return system.exists(hadoop)


def remove(spark: SparkSession, pattern: str) -> None:
    """Remove the files and folders a glob pattern finds; none is fine."""
    system, hadoop = _at(spark, pattern)
    for found in system.globStatus(hadoop) or []:
        system.delete(found.getPath(), True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder."""
    system, hadoop = _at(spark, folder)
    return [found.getPath().getName() for found in system.listStatus(hadoop)]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if there is one of that name, which is left as it is.

    Of several writers one wins, as far as the file system creates without overwriting in one step. A local
    one does so for an empty file only, so there the name is taken first by a file beside it.
    """
    from py4j.protocol import Py4JJavaError

    system, hadoop = _at(spark, path)
    system.mkdirs(hadoop.getParent())
    if hadoop.toUri().getScheme() in (None, "file"):
        beside = hadoop.getParent().suffix(f"/.{hadoop.getName()}.taken").toUri().getPath()
        if not spark._jvm.java.io.File(beside).createNewFile():
            return False
    try:
        out = system.create(hadoop, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True
