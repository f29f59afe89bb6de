"""Exactly-once pick-up of monthly trip files (S7) with Structured Streaming.

A file-source stream over the landing folder, run with
``trigger(availableNow=True)``: each run processes every file not yet seen
(the source's own log in the checkpoint remembers processed files) and stops.
The stream carries file paths; each micro-batch reads its files by their own
footers, lands them (typed projection + provenance) and writes them by
``foreachBatch`` into the raw table partition of its batch id with dynamic
overwrite, so a batch replayed after a failure replaces its own output
instead of appending a second copy.

A batch's load stamp is stored beside the checkpoint before the batch's first
write and used again when the batch is replayed; a new batch's stamp is later
than every stored one. A strict high-water mark downstream therefore admits
each batch exactly once, however often runs fail or reuse a stamp.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources.files import land_columns, read_trip_files
from meterline.sources.storage import read_record, record_names, write_record

BATCH_COL = "_ingest_batch"
# Spark's own schema of a binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def batch_stamp(spark: SparkSession, path: str, batch_id: int, loaded_at: str) -> _dt.datetime:
    """The stored stamp of a batch, or a new one: ``loaded_at``, or one
    microsecond after the latest stored stamp if that is later."""
    names, own = record_names(spark, path), f"{batch_id:012d}.json"
    if own in names:
        return _dt.datetime.fromisoformat(read_record(spark, f"{path}/{own}")["stamp"])
    stamp = _dt.datetime.fromisoformat(loaded_at)
    if names:   # stamps grow with the batches: the last is the latest
        latest = _dt.datetime.fromisoformat(read_record(spark, f"{path}/{names[-1]}")["stamp"])
        stamp = max(stamp, latest + _dt.timedelta(microseconds=1))
    write_record(spark, f"{path}/{own}", {"stamp": stamp.isoformat()})
    return stamp


def stream_ingest(spark: SparkSession, source_glob: str, raw_path: str, checkpoint: str,
                  loaded_at: str, max_files_per_trigger: int | None = None,
                  on_batch=None) -> None:
    """Land all not-yet-seen files matching ``source_glob`` into ``raw_path``.

    ``loaded_at`` is the earliest stamp of this run's new batches (see
    ``batch_stamp``). ``on_batch(landed_df, batch_id)`` may add work per batch
    (e.g. the incremental models); it runs after the raw write. A batch's file
    paths reach the driver; ``max_files_per_trigger`` bounds them.
    """
    # Of a binary file source only the path is read, never the content.
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_glob).select("path")
    stamps = f"{checkpoint.rstrip('/')}_stamps"

    def write_batch(df: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in df.collect())
        stamp = batch_stamp(spark, stamps, batch_id, loaded_at).isoformat(sep=" ")
        landed = land_columns(read_trip_files(spark, paths), stamp).withColumn(
            BATCH_COL, F.lit(batch_id).cast("bigint"))
        (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(BATCH_COL).parquet(raw_path))
        if on_batch is not None:
            on_batch(landed, batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_trips(spark: SparkSession, source_glob: str, raw_path: str, checkpoint: str,
                 loaded_at: str, seed: DataFrame, tables, cfg,
                 max_files_per_trigger: int | None = None) -> None:
    """Files -> raw -> incremental intermediate and fact -> marts, per micro-batch.

    The exactly-once file pick-up (S7) feeding the delete+insert models (I2)
    in ``foreachBatch``; replaying a batch is safe because it carries its first
    stamp again and the upserts are idempotent by key.
    """
    from meterline.plans.models import run_pipeline

    def models(landed: DataFrame, batch_id: int) -> None:
        run_pipeline(spark, landed.drop(BATCH_COL), seed, tables, cfg,
                     ("staging", "intermediate", "marts"))

    stream_ingest(spark, source_glob, raw_path, checkpoint, loaded_at,
                  max_files_per_trigger, on_batch=models)
