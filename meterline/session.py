"""Session construction and shared-folder helpers.

Everything that must outlive a task (lineage cuts, staged upserts, stream
checkpoints) goes under the folder the cluster names in ``spark.checkpoint.dir``.
A private folder is created only when the session has none set and runs in one
process (master ``local``: tests, bench); on a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed session settings the operators rely on.
SESSION_DEFAULTS = {
    # Trip timestamps are wall-clock (TIMESTAMP_NTZ); some plans cast them to
    # zoned timestamps internally, so the zone must be pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions to the advisory size, not to the default
    # parallelism: on a large cluster a generous spark.sql.shuffle.partitions
    # then costs nothing for small stages and still splits big ones.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "meterline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Pin the runtime SQL settings the operators' semantics depend on."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, SESSION_DEFAULTS[k])


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared checkpoint folder; set a private one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meterline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """``key`` set to ``value`` for what runs inside; the session's own holds
    again afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def at_most(spark: SparkSession, key: str, size: str):
    """``setting`` of a size in bytes; a smaller one of the session stays."""
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = spark.conf.get(key)
    return setting(spark, key, size if in_bytes(size) < in_bytes(before) else before)


def scan_pieces(spark: SparkSession, size: str):
    """Files that are read inside go to a task in pieces of at most ``size``."""
    return at_most(spark, "spark.sql.files.maxPartitionBytes", size)


def shuffle_pieces(spark: SparkSession, size: str):
    """Small shuffle partitions inside are put together up to ``size`` only."""
    return at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", size)


def dropped_shuffles(spark: SparkSession):
    """The shuffle files of a query that runs inside go when it ends, not when the
    driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def open_files(spark: SparkSession, most: int):
    """A task of a partitioned write inside keeps up to ``most`` partitions' files
    open; it sorts (and spills) only the rows of partitions beyond them."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))
