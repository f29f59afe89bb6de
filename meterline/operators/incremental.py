"""Incremental processing.

* ``high_water_mark``  one-row max of a column (floored), fetched as a literal
  so the slice predicate reaches the Parquet scan and partition pruning. For
  tables written by ``upsert`` it is read from the marks the writes recorded,
  not by scanning the table.
* ``new_rows``         strict ``>`` slice of a batch above the target's mark.
* ``dedupe_latest``    one row per key, the latest by ``order`` with every
  other column as tie-breaker. Written as an aggregate (max of a struct), so
  partial aggregation collapses a hot key on the map side instead of sorting
  all its copies in one task, as a ``row_number`` window would.
* ``upsert_frame``     delete+insert by key as a lazy DataFrame.
* ``upsert``           the same against a partitioned Parquet table, rewriting
  only the partitions the batch touches; crash-safe, with a declared schema.
* ``replaced_rows``    where a stored table's rows lie whose key a batch brings
  again: a bit per row, from a shuffle of the keys alone.
* ``read_table``       such a table, by its declared schema; never writes.
* ``unapplied``        what a table derived from it has not taken over yet.
* ``sync_columns``     align a target to a batch's columns (add / drop).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from contextlib import ExitStack
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.session import dropped_shuffles, open_files, scan_pieces, shuffle_pieces
from meterline.sources.files import rebalanced
from meterline.sources.storage import (delete_path, names_in, read_record, record_names,
                                       write_record)
from meterline.sources.storage import exists as _exists
from meterline.sources.storage import move as _move

DEFAULT_FLOOR = "1900-01-01 00:00:00"


# Hidden folder inside a table (Spark's reader skips names starting with '_')
# with one small file per write, in order: its number and id, the table's schema
# from then on, the partitions it replaced (null: all), the max of each watermark
# column so far, and which values of a mapped column writes have put in which
# partition so far.
MARKS_DIR = "_watermarks"
# Hidden folder of a merge that is written but not yet swapped in.
PENDING_DIR = "_pending"
# Hidden file of a derived table: the last write of its source that it holds.
APPLIED = "_applied/mark.json"


def high_water_mark(target: DataFrame | None, col: str, floor: str = DEFAULT_FLOOR,
                    path: str | None = None):
    """``coalesce(max(col), floor)`` of the target; ``floor`` when it is missing.

    The floor also covers an existing but empty target, where a bare max is
    NULL and a strict comparison against it would load nothing. With ``path``
    (a table written by ``upsert(..., watermark_cols=...)``) the max comes
    from the marks its writes recorded, a few rows, instead of a scan of the
    column over the whole table; without recorded marks it scans. The record
    is exact only if every write to that table goes through ``upsert`` with
    the column in ``watermark_cols`` (as ``run_pipeline`` does).
    """
    if target is None:
        return floor
    last = _last_write(target.sparkSession, path) if path else None
    if last is None or last["marks"].get(col) is None or col not in target.columns:
        m = target.agg(F.max(col).alias("m")).first()["m"]
    else:
        m = _typed(last["marks"][col], dict(target.dtypes)[col])
    return floor if m is None else m


def _typed(value, dtype: str):
    """A recorded value as a column of ``dtype`` gives it."""
    if dtype.startswith("timestamp"):
        return _dt.datetime.fromisoformat(value)
    if dtype == "date":
        return _dt.date.fromisoformat(value)
    return Decimal(value) if dtype.startswith("decimal") else value


def _numbers(spark: SparkSession, path: str) -> list[str]:
    """Names of a stored table's write records, the first write's first."""
    return record_names(spark, f"{path.rstrip('/')}/{MARKS_DIR}")


def _write(spark: SparkSession, path: str, name: str) -> dict:
    return read_record(spark, f"{path.rstrip('/')}/{MARKS_DIR}/{name}")


def _last_write(spark: SparkSession, path: str) -> dict | None:
    """The record of a stored table's last write; None if its first has not ended."""
    names = _numbers(spark, path)
    return _write(spark, path, names[-1]) if names else None


def _record(spark: SparkSession, at: str, schema: T.StructType, before: dict | None, marks: dict,
            replaced: Sequence | None, mapped: Sequence[tuple]) -> None:
    """Write one write's record into the folder ``at``."""
    # Every column is declared nullable: older partitions may lack it.
    declared = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    highest = {}
    for c, v in marks.items():
        old = before["marks"].get(c) if before else None
        known = [x for x in (v, None if old is None else _typed(old, types[c])) if x is not None]
        highest[c] = max(known).isoformat() if known and isinstance(known[0], _dt.date) else max(known, default=None)
    pairs = {tuple(p) for p in (before["map"] if before else [])} | set(mapped)
    n, write = (before["n"] + 1 if before else 0), uuid.uuid4().hex
    write_record(spark, f"{at}/{n:012d}-{write}.json", {
        "n": n, "write": write, "declared": declared.json(), "marks": highest,
        "parts": None if replaced is None else [None if v is None else str(v) for v in replaced],
        "map": sorted(pairs, key=str)})


def partitions_above(spark: SparkSession, path: str, col: str, mark) -> list[str | None] | None:
    """Partitions (as text) that can hold rows with ``col`` above ``mark``: those
    replaced by the writes that raised the max beyond it and all later ones. None:
    any can."""
    names, parts = _numbers(spark, path), set()
    for name in reversed(names):
        record = _write(spark, path, name)
        highest = record["marks"].get(col)
        if highest is None:
            return None
        dtype = T.StructType.fromJson(json.loads(record["declared"]))[col].dataType.simpleString()
        if not _typed(highest, dtype) > (_typed(mark, dtype) if isinstance(mark, str) else mark):
            return sorted(parts, key=str)
        if record["parts"] is None:
            return None
        parts |= set(record["parts"])
    return None


def partitions_with(spark: SparkSession, path: str, values: Sequence) -> list[str | None]:
    """Partitions (as text) in which a write has put any of the mapped column's
    ``values``: a superset of those that hold them now."""
    wanted = {None if v is None else str(v) for v in values}
    return sorted({part for v, part in _last_write(spark, path)["map"] if v in wanted}, key=str)


def values_in(spark: SparkSession, path: str, parts: Sequence[str | None]) -> list[str | None]:
    """The mapped column's values (as text) that any write has put in ``parts``:
    what they held before their last write included."""
    return sorted({v for v, part in _last_write(spark, path)["map"] if part in set(parts)}, key=str)


def unapplied(spark: SparkSession, path: str, derived: str) -> tuple[dict, list[str | None] | None]:
    """(mark of the last write of the table ``path``, partitions replaced by the
    writes that the table ``derived`` does not hold yet; None: all)."""
    names = _numbers(spark, path)
    last = _write(spark, path, names[-1])
    mark, at = {"n": last["n"], "write": last["write"]}, f"{derived.rstrip('/')}/{APPLIED}"
    held = read_record(spark, at) if _exists(spark, at) else None
    if held is None or not any(held["write"] in n for n in names):   # none, or of a table since written anew
        return mark, None
    later = [_write(spark, path, n) for n in names if int(n.split("-")[0]) > held["n"]]
    if any(r["parts"] is None for r in later):
        return mark, None
    return mark, sorted({p for r in later for p in r["parts"]}, key=str)


def record_applied(spark: SparkSession, derived: str, mark: dict) -> None:
    """Note that ``derived`` holds its source's writes up to ``mark``; its own
    write has ended."""
    write_record(spark, f"{derived.rstrip('/')}/{APPLIED}", mark)


def in_partitions(col: str, dtype: str, parts: Sequence[str | None]) -> Column:
    """A filter on a partition column that prunes: literals of its type."""
    known = [F.lit(p).cast(dtype) for p in parts if p is not None]
    hit = F.col(col).isin(known) if known else F.lit(False)
    return hit | F.col(col).isNull() if any(p is None for p in parts) else hit


def new_rows(batch: DataFrame, target: DataFrame | None, col: str,
             floor: str = DEFAULT_FLOOR, path: str | None = None) -> DataFrame:
    """Rows of ``batch`` strictly above the target's high-water mark (I1);
    ``path`` lets the mark come from the target's recorded marks."""
    mark = high_water_mark(target, col, floor, path)
    dtype = dict(batch.dtypes)[col]
    if isinstance(mark, (_dt.datetime, _dt.date)):
        mark = mark.isoformat(sep=" ") if isinstance(mark, _dt.datetime) else mark.isoformat()
    return batch.filter(F.col(col) > F.lit(mark).cast(dtype))


def dedupe_latest(df: DataFrame, key: Sequence[str] | str,
                  order: Sequence[str] | str = ("_loaded_at",)) -> DataFrame:
    """Latest row per ``key`` (W3, row_number() = 1 over ``order desc``).

    NULL in an ``order`` column counts as the largest value (it wins), then
    every remaining column breaks ties (larger wins, NULL smallest), so the
    survivor is fully determined. NULL keys form one group, as in a window.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    # One struct in tie order; the winner's columns are read back from it.
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
    fields += [F.col(c).alias(f"r{i}") for i, c in enumerate(rest)]
    place = {**{c: f"o{i}" for i, c in enumerate(order)}, **{c: f"r{i}" for i, c in enumerate(rest)}}
    return (df.groupBy(*key).agg(F.max(F.struct(*fields)).alias("__best"))
              .select(*[F.col(c) if c in key else F.col(f"__best.{place[c]}").alias(c)
                        for c in df.columns]))


# Pieces that a partition's rows are dealt in by key when a merge is written.
PIECES = 16
# What a task reads of a table whose rows are written on as they lie.
CLUSTERED_PIECE = "32m"
# Partitions whose files such a task keeps open; it sorts the rows of any beyond.
OPEN_FILES = 32
# Shuffled bytes of keys that a task sorts, some 20 a row: a full piece would be
# millions of rows.
KEYS_PIECE = "32m"
# Rows of a bitmap (2 ** 15, what ``bitmap_construct_agg`` holds), and rows whose
# bits are broadcast at once (64 MB) if they lie in more than one partition.
BITMAP_SHIFT = 15
BITS = 2 ** 29
# A partition of more files than this, of so few rows each, is dealt anew by a merge.
MANY_FILES, FEW_ROWS = 4 * PIECES, 100_000


def upsert_frame(target: DataFrame | None, batch: DataFrame,
                 key: Sequence[str] | str, by: Sequence[str] = ()) -> DataFrame:
    """Delete+insert by key (I2/I3) as a DataFrame: target rows whose key
    appears in the batch are replaced by all of the batch's rows. A key with a
    NULL equals none.

    Both inputs are computed once and meet in one shuffle by key. ``by`` names
    columns that the key determines (a table's partitions): the rows are then
    dealt by them and by ``PIECES`` pieces of the keys, so that they can be
    written without another shuffle.
    """
    key = [key] if isinstance(key, str) else list(key)
    if target is None:
        return batch
    target, batch = sync_columns(target, batch)
    both = (target.withColumn("__new", F.lit(False))
                  .unionByName(batch.withColumn("__new", F.lit(True))))
    no_key = F.lit(False)
    for c in key:
        no_key = no_key | F.col(c).isNull()
    # Rows without a key are dealt by their other columns.
    plain = [f.name for f in batch.schema.fields if isinstance(f.dataType, T.AtomicType)]
    both = both.withColumn("__apart", F.when(no_key, F.xxhash64(*plain)))
    group = [*key, "__apart"]
    if by:
        both = both.withColumn("__piece", F.pmod(F.xxhash64(*group), F.lit(PIECES)))
        both = both.repartition(*by, "__piece")
        group = [*by, "__piece", *group]
    both = both.withColumn("__replaced", F.max("__new").over(Window.partitionBy(*group)))
    return (both.filter(F.col("__new") | ~F.col("__replaced") | F.col("__apart").isNotNull())
                .select(*batch.columns))


def _packed(df: DataFrame, c: str) -> Column:
    """A key column in fewer bytes, one to one: a text of lower-case hex digits as
    the bytes they stand for, any other as its own; the last byte says which."""
    if df.schema[c].dataType != T.StringType():
        return F.col(c)
    hexed = F.unhex(c)
    return F.when(F.lower(F.hex(hexed)) == F.col(c), F.concat(hexed, F.lit(b"\x01"))).otherwise(
        F.concat(F.col(c).cast("binary"), F.lit(b"\x00"))).alias(c)


def _place() -> dict[str, Column]:
    """Where a row of a stored table lies in its partition; ``_turns`` makes sure that
    no two files of one have a hash in common."""
    return {"__file": F.xxhash64("_metadata.file_name"), "__row": F.col("_metadata.row_index")}


def replaced_rows(old: DataFrame, batch: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The rows of the stored table ``old`` whose key is in ``batch``, by their
    places: per partition ``by``, file (``__file``, a hash of its name) and
    2 ** ``BITMAP_SHIFT`` rows of it (``__at``) a bitmap (``__bits``) with a bit per
    row, the lowest first.

    Only keys and places are shuffled, by partition and ``PIECES`` pieces of the
    keys. The bitmaps take a bit per row of ``old``. A key with a NULL equals none.
    """
    keys = [F.col(c).cast(batch.schema[c].dataType).alias(c) for c in [*by, *key]]
    none = F.lit(None).cast("bigint")
    both = old.withColumns(_place()).select(*keys, "__file", "__row").unionByName(
        batch.select(*by, *key, none.alias("__file"), none.alias("__row")))
    both = both.dropna(subset=list(key))
    both = both.select(*by, *[_packed(both, c) for c in key], "__file", "__row")
    both = both.withColumn("__piece", F.pmod(F.xxhash64(*key), F.lit(PIECES))).repartition(*by, "__piece")
    # The key first: its leading bytes decide nearly every comparison of the sort.
    new = F.max(F.col("__file").isNull()).over(Window.partitionBy(*key, *by, "__piece"))
    hit = both.withColumn("__new", new).filter(F.col("__new") & F.col("__file").isNotNull())
    return (hit.groupBy("__file", F.shiftright("__row", BITMAP_SHIFT).alias("__at"), *by)
               .agg(F.bitmap_construct_agg(F.col("__row") % (1 << BITMAP_SHIFT)).alias("__bits")))


def _without(old: DataFrame, replaced: DataFrame, by: Sequence[str]) -> DataFrame:
    """``old`` as it lies, less the rows at the places of ``replaced_rows``."""
    rows = old.withColumns(_place())
    r = replaced.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(by)], F.col("__file").alias("__in"),
                        "__at", "__bits")
    byte = F.expr(f"substring(__bits, cast((__row % {1 << BITMAP_SHIFT}) div 8 + 1 as int), 1)")
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("__row") % 8).cast("int"))
    same = (F.col("__file") == F.col("__in")) & (F.shiftright("__row", BITMAP_SHIFT) == F.col("__at")) & (bit == 1)
    for i, c in enumerate(by):
        same = same & F.col(c).cast(replaced.schema[c].dataType).eqNullSafe(F.col(f"__{i}"))
    return rows.join(F.broadcast(r), same, "left_anti").select(*old.columns)


def _turns(old: DataFrame, by: Sequence[str]) -> list[list[tuple]] | None:
    """The partitions of the stored ``old`` in groups of at most ``BITS`` rows, or of
    one partition; None if one lies in so many small files that it is to be dealt
    anew, or two of its files cannot be told apart. The files' footers tell."""
    files = (old.groupBy(*by, F.col("_metadata.file_name").alias("__name")).agg(F.count(F.lit(1)).alias("__n"))
                .withColumn("__file", F.xxhash64("__name")))
    sizes = files.groupBy(*by).agg(F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__files"),
                                   F.count_distinct("__file").alias("__told")).collect()
    if any(r["__files"] > MANY_FILES and r["__n"] < r["__files"] * FEW_ROWS or r["__told"] < r["__files"]
           for r in sizes):
        return None
    turns, n = [], 0
    for r in sizes:
        n += r["__n"]
        if not turns or n > BITS:
            turns, n = [*turns, []], r["__n"]
        turns[-1].append(tuple(r)[:len(by)])
    return turns


def _schema_of(record: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(record["declared"]))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table written by ``upsert`` is there: its first write ended."""
    return bool(_numbers(spark, path))


def _leaves(spark: SparkSession, root: str, under: str = "") -> list[str]:
    """Partition folders below ``root`` ('a=1/b=2'), without hidden ones."""
    inner = [n for n in names_in(spark, f"{root}/{under}".rstrip("/")) if "=" in n and n[0] not in "_."]
    if not inner:
        return [under] if under else []
    return [leaf for n in inner for leaf in _leaves(spark, root, f"{under}/{n}".lstrip("/"))]


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written by ``upsert``, by its declared schema; None if there is
    none.

    A column added by a later batch reads as NULL in partitions that no batch
    has touched since, a dropped one is gone from all, and a table without any
    row reads as empty. Reading never writes: where a crash left a merge
    between its write and the end of its swap, the partitions still pending
    are read from there, so no reader sees a partition half replaced.
    """
    root = path.rstrip("/")
    at = f"{root}/{PENDING_DIR}"
    last, pending = _last_write(spark, path), _last_write(spark, at)
    if last is None or pending is None:
        return None if last is None else spark.read.schema(_schema_of(last)).parquet(path)
    schema = _schema_of(pending)
    waiting = _leaves(spark, f"{at}/rows")
    out = spark.createDataFrame([], schema)
    for base, leaves in ((f"{at}/rows", waiting),
                         (root, [x for x in _leaves(spark, root) if x not in set(waiting)])):
        if leaves:
            out = out.unionByName(spark.read.schema(schema).option("basePath", base)
                                       .parquet(*[f"{base}/{x}" for x in leaves]))
    return out


def _finish_pending(spark: SparkSession, path: str) -> None:
    """Swap a complete pending merge in, folder by folder, then publish its
    record; drop an incomplete one. What a crash left undone is done by the
    next call: moved folders are no longer there."""
    root = path.rstrip("/")
    at = f"{root}/{PENDING_DIR}"
    for name in _numbers(spark, at):
        for leaf in _leaves(spark, f"{at}/rows"):
            _move(spark, f"{at}/rows/{leaf}", f"{root}/{leaf}")
        _move(spark, f"{at}/{MARKS_DIR}/{name}", f"{root}/{MARKS_DIR}/{name}")
    delete_path(spark, at)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a lost writer of the table left; for its writer to call."""
    if _exists(spark, f"{path.rstrip('/')}/{PENDING_DIR}"):
        _finish_pending(spark, path)


# Types that Parquet files are read as without being rewritten.
_WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
          "int": ("bigint", "double"), "float": ("double",)}


def _touched(types: dict[str, str], cols: Sequence[str], parts: Sequence[tuple]) -> Column:
    """Rows in any of ``parts``; prunes partitions. A flat list for one column,
    else a balanced tree of ORs."""
    if len(cols) == 1:
        return in_partitions(cols[0], types[cols[0]], [None if v is None else str(v) for v, in parts])
    hits = []
    for values in parts:
        hit = F.lit(True)
        for c, v in zip(cols, values):
            hit = hit & F.col(c).eqNullSafe(F.lit(v).cast(types[c]))
        hits.append(hit)
    while len(hits) > 1:
        hits = [hits[i] | hits[i + 1] if i + 1 < len(hits) else hits[i] for i in range(0, len(hits), 2)]
    return hits[0]


def upsert(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str] | str,
           partition_cols: Sequence[str], full_refresh: bool = False,
           parts: Sequence[tuple] | None = None,
           watermark_cols: Sequence[str] = (), map_col: str | None = None,
           clustered: bool = False) -> None:
    """Delete+insert ``batch`` into the partitioned Parquet table at ``path``.

    Precondition: the key determines the partition (rows sharing a key share
    partition values), so only the partitions the batch touches change. Those
    partitions are read (pruned by a literal list of the batch's partition
    values) and merged with the batch in one shuffle (``upsert_frame``). If both lie
    by partition (``clustered``), only their keys are shuffled (``replaced_rows``):
    the batch's rows, then the rows they do not replace are written as they lie.

    Crash safety: the merged partitions are written once, whole, beside the
    table (``_pending``), with the write's record as their commit; then their
    folders take the place of the old ones by name and the record is published.
    A run that dies before the record has changed nothing; one that dies in the
    swap is finished by the next ``upsert`` (or ``recover``), and until then
    ``read_table`` reads what is still pending from there. A rerun of the same
    batch produces the same table. The first write and a full refresh replace
    the whole table and record it last: until then the table does not exist,
    and a rerun starts anew. ``parts`` may pass the batch's distinct partition
    values when the caller already has them.

    Files follow partitions. A first write is dealt by them (``rebalanced``):
    adaptive execution cuts a heavy partition into several files and writes a
    small one as one; not so with ``clustered``, for rows that already lie
    together by partition (the scan of a table partitioned alike): they are read
    in small pieces, and a task keeps several partitions' files open instead of
    sorting. A merge is written as its shuffle dealt it, a partition in up to
    ``PIECES`` files; so is one with ``clustered`` that finds a partition in more
    than ``MANY_FILES`` small files, else it adds to them as the batch lies.

    Columns follow the batch (I5): the table's declared schema becomes the
    batch's. Added and dropped columns need no rewrite (see ``read_table``), nor
    does a wider number type, which old files are read as; any other change of
    a column's type rewrites all partitions.

    ``watermark_cols``: the write also records each column's max (an
    ``observe`` on the write job, no extra pass) for ``high_water_mark``.
    The recorded max is the table's max as long as replacing a key's rows
    never lowers a column's max (true for the load stamp, which only grows,
    and for columns the key determines, like the pickup time in trip_id); a
    full refresh starts the record anew. Beside the marks stand the partitions
    the write replaced (``partitions_above``, ``unapplied``).

    ``map_col``: a column with few values per partition (a month); the write
    records which of its values lie in which partition (``partitions_with``).
    Both records name values of the first partition column.
    """
    from pyspark.sql import Observation
    root = path.rstrip("/")
    cols = [c for c in watermark_cols if c in batch.columns]
    watched = [F.max(c).alias(c) for c in cols]
    if map_col:
        watched.append(F.collect_set(F.struct(F.col(map_col).cast("string").alias("v"), F.col(
            partition_cols[0]).cast("string").alias("part"))).alias("__map"))
    seen = []

    def writer(df: DataFrame, mode: str = "overwrite"):
        if watched:
            seen.append(Observation(f"upsert_marks_{len(seen)}"))
            df = df.observe(seen[-1], *watched)
        return (df.write.mode(mode).option("partitionOverwriteMode", "static")
                  .option("compression", "zstd").partitionBy(*partition_cols))

    def lie(old: DataFrame, to: str, turns: list[list[tuple]]) -> None:
        """The batch's rows, then those of ``old`` that it does not replace, as they lie."""
        writer(batch).format("parquet").save(to)
        fresh = spark.read.schema(batch.schema).parquet(to)
        for turn in turns:
            here, by = old.filter(_touched(types, partition_cols, turn)), partition_cols
            new = fresh.filter(_touched(dict(batch.dtypes), by, turn))
            kept = _without(here, replaced_rows(here, new, key, by), by)
            writer(sync_columns(kept, batch)[0], "append").parquet(to)

    def record(df: DataFrame, to: str, before: dict | None, replaced: list | None) -> None:
        marks = {c: max((o.get[c] for o in seen if o.get[c] is not None), default=None) for c in cols}
        _record(spark, f"{to}/{MARKS_DIR}", df.schema, before, marks, replaced,
                [tuple(r) for o in seen for r in o.get["__map"]] if map_col else [])

    key = [key] if isinstance(key, str) else list(key)
    recover(spark, path)
    last = None if full_refresh else _last_write(spark, path)
    if last is None:
        # Observed above the shuffle: an empty one leaves the plan.
        first = batch if clustered else rebalanced(batch, partition_cols)
        with dropped_shuffles(spark), ExitStack() as lying:
            if clustered:
                lying.enter_context(open_files(spark, OPEN_FILES))
                lying.enter_context(scan_pieces(spark, CLUSTERED_PIECE))
            writer(first).parquet(path)
        record(batch, root, None, None)
        return
    # Distinct partition values of the batch: one row per touched partition.
    if parts is None:
        parts = [tuple(r) for r in batch.select(*partition_cols).distinct().collect()]
    if not parts:
        return
    target = spark.read.schema(_schema_of(last)).parquet(path)
    types = dict(target.dtypes)
    rewrite = any(types.get(c, t) != t and t not in _WIDER.get(types[c], ()) for c, t in batch.dtypes)
    old = target if rewrite else target.filter(_touched(types, partition_cols, parts))
    at = f"{root}/{PENDING_DIR}"
    turns = _turns(old, partition_cols) if clustered else None
    with dropped_shuffles(spark):
        if turns is None:
            writer(upsert_frame(old, batch, key, partition_cols)).parquet(f"{at}/rows")
        else:
            with open_files(spark, OPEN_FILES), shuffle_pieces(spark, KEYS_PIECE):
                lie(old, f"{at}/rows", turns)
    record(batch, at, last, None if rewrite else [v[0] for v in parts])
    _finish_pending(spark, path)


def sync_columns(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Align columns (I5, 'sync all columns'): the batch's column list wins.

    Columns new in the batch are added to the target as typed NULLs; columns
    the batch no longer has are dropped from the target.
    """
    ttypes = dict((f.name, f.dataType) for f in target.schema.fields)
    cols = []
    for f in batch.schema.fields:
        if f.name in ttypes:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.select(*cols), batch


def stage(spark: SparkSession, df: DataFrame, name: str,
          distinct_of: Sequence[str] = ()) -> tuple[DataFrame, str, list[tuple]]:
    """Compute ``df`` once into a fresh folder under the shared checkpoint
    directory and return (a DataFrame reading it, its path, the distinct
    value tuples of ``distinct_of``).

    ``distinct_of`` names columns with few distinct values (partition values,
    months): they are gathered by an ``observe`` on the staging write, so
    finding the partitions a batch touches costs no job of its own.

    Used for a batch that is needed more than once (its touched partitions,
    then the merge): it is computed once instead of per use, and its lineage
    is cut, so a task lost later re-reads the staged files instead of
    recomputing the batch's joins and shuffles.
    """
    from pyspark.sql import Observation
    from meterline.session import scratch_path
    path = scratch_path(spark, name)
    seen = Observation("staged") if distinct_of else None
    out = df.observe(seen, F.collect_set(F.struct(*distinct_of)).alias("v")) if seen else df
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    values = [tuple(r) for r in seen.get["v"]] if seen else []
    return spark.read.schema(df.schema).parquet(path), path, values


def month_of_run(ds: str) -> str:
    """Run date 'YYYY-MM-DD' -> the monthly file it belongs to, 'YYYY-MM' (I8)."""
    _dt.date.fromisoformat(ds)
    return ds[:7]

