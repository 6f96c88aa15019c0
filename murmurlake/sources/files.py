"""Small files on whatever file system a path names, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, system = _system(spark, path)
    return system.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, system = _system(spark, path)
    return system.exists(p) and system.getFileStatus(p).isDirectory()


def required(spark: SparkSession, path: str) -> str:
    """The path; a named path that isn't there is an error, not an empty table."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    p, system = _system(spark, path)
    stream = system.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in place of one that may be there."""
    p, system = _system(spark, path)
    stream = system.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def append_text(spark: SparkSession, path: str, text: str) -> None:
    """Add lines to a small file; object stores can't append, so it is written anew beside it and renamed."""
    p, system = _system(spark, path)
    before = read_text(spark, path) if system.exists(p) else ""
    if before and not before.endswith("\n"):
        before += "\n"
    write_text(spark, f"{path}.new", before + text)
    system.delete(p, False)
    system.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new"), p)
