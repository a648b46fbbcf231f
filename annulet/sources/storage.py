"""Small texts in whatever file system a path names, through Hadoop's: manifests, configurations and reports."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _place(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _place(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Written beside the path first, then put in its place, so that a reader never sees half of it."""
    p, fs = _place(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(p, False)
    fs.rename(fresh, p)
