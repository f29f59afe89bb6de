"""Helpers the training-data operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_path

#: Rows of one Arrow batch handed to Python: keeps a batch of long texts small.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker's input batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set to ``value`` for what runs inside; the session's own holds
    again afterwards."""
    own = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, own)


def batch_rows(spark: SparkSession, rows: int):
    """Hand Python ``rows`` rows at a time, for what runs inside."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` computed once into the cluster's shared folder and read back, and
    its folder: the lineage is cut, and a task lost later re-reads the files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    return stored(df, name)[0]


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only. ``lower`` is that (and much faster) on ASCII text;
    other text goes through ``translate``, which leaves its other letters."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
             .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def text_of(col: Column | str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``: the train / held-out split. A
    NULL key is in no fold (-1)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(-1))


def map_rows(df: DataFrame, fn: Callable[[Iterator[list[list]]], Iterable[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``mapInArrow`` whose function gets each batch as lists, one per column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn([c.to_pylist() for c in b.columns] for b in batches)
    return df.mapInArrow(run, schema)


def batch_of(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    """A record batch from name=(values, type)."""
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()],
                                      names=list(columns))
