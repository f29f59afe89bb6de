"""Small files beside tables, by the Hadoop file system API: any path Spark reads.

Records of a few hundred bytes (a write's record, a mark, a stamp) are read and
written by the driver itself, without a Spark job. A record appears whole or not
at all: it is written under a hidden name and renamed.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import SparkSession


@functools.lru_cache(maxsize=4)
def _path_class(jvm):
    return jvm.org.apache.hadoop.fs.Path


def located(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    sc = spark.sparkContext
    at = _path_class(sc._jvm)(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = located(spark, path)
    return fs.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    fs, at = located(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(at)) if fs.exists(at) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, at = located(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, to: str) -> None:
    """Put a folder or file in the place of another, by name."""
    fs, at = located(spark, source)
    new = _path_class(spark.sparkContext._jvm)(to)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(at, new):
        raise OSError(f"cannot move {source} to {to}")


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """Write ``record`` as the JSON file ``path``."""
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}"
    fs, at = located(spark, hidden)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(record, default=str).encode()))
    out.close()
    move(spark, hidden, path)


def read_record(spark: SparkSession, path: str) -> dict:
    fs, at = located(spark, path)
    stream = fs.open(at)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def record_names(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in names_in(spark, folder) if n.endswith(".json") and not n.startswith(".")]
