"""Sharding along a Hilbert curve (native only).

Several metadata columns are quantised to a grid, each cell gets its place on
the Hilbert curve, rows are sorted by that place and the order is cut into runs
of equal row counts (counts differ by one at most). Rows of one run are close
in every dimension, so the min / max of its files prune on each of them.

* Quantiles: one pass of ``percentile_approx`` over all rows gives the bucket
  bounds of numbers, dates and times. Strings are ranked whole: rows are counted
  per distinct value, and a running count over the sorted values tells where each
  bucket begins, however long a start the values share. Only the bounds,
  2**bits - 1 values per dimension, reach the driver.
* Curve: the curve is a finite automaton; its table (states x cells) is built
  from the Gray-code rule below and walked, bit plane by bit plane, with the
  SQL ``aggregate`` function.
* Order: a range shuffle on (place, tie-breakers), so one place holding a third
  of the rows is still cut between tasks; a row's rank is its index within its
  sorted partition plus the sizes of the partitions before (one row each).

Defined cases: NULL in a dimension falls in the lowest bucket. Ties of the
curve are ordered by the tie-breakers; rows equal in all of them are
interchangeable. An empty table gives an empty result. Very long values are
compared whole. Columns named curve, shard or slot that the rows already have are
returned with ``own_`` before their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import text_of, written



def curve_table(dims: int) -> tuple[list[int], list[int], int]:
    """The curve's automaton for ``dims`` dimensions: digit and next state of
    (state * 2**dims + cell); state 0 starts.

    A state is (entry corner e, direction d) of a sub-cube. A cell's digit is
    the Gray-code rank of the cell seen from that corner; the sub-cube of rank
    w is entered at gray(2 * ((w - 1) // 2)) and left along the direction of
    w's trailing one bits, both turned back into the outer frame.
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & (size - 1)

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    rank = {gray(w): w for w in range(size)}

    def trailing_ones(x: int) -> int:
        return (x ^ (x + 1)).bit_length() - 1

    def step(e: int, d: int, cell: int) -> tuple[int, tuple[int, int]]:
        w = rank[turn(cell ^ e, d + 1)]
        entry = 0 if w == 0 else gray(2 * ((w - 1) // 2))
        along = 0 if w == 0 else (trailing_ones(w) if w % 2 else trailing_ones(w - 1)) % dims
        return w, (e ^ turn(entry, -(d + 1)), (d + along + 1) % dims)

    states, digits, nexts, i = [(0, 0)], [], [], 0
    while i < len(states):
        for cell in range(size):
            w, to = step(*states[i], cell)
            if to not in states:
                states.append(to)
            digits.append(w)
            nexts.append(states.index(to))
        i += 1
    return digits, nexts, len(states)


def curve_place(coords: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a grid cell (each coordinate < 2**bits)."""
    dims = len(coords)
    digits, nexts, _ = curve_table(dims)
    table = F.array(*[F.lit(d * 65536 + n) for d, n in zip(digits, nexts)])

    def walk(acc: Column, plane: Column) -> Column:
        cell = F.lit(0)
        for k, c in enumerate(coords):
            bit = F.call_function("shiftright", c.cast("int"), plane).bitwiseAND(F.lit(1))
            cell = cell + bit * (1 << (dims - 1 - k))
        hit = F.element_at(table, (acc["state"] * (1 << dims) + cell + 1).cast("int"))
        return F.struct((acc["place"] * (1 << dims) + F.call_function("shiftright", hit, F.lit(16)))
                        .cast("long").alias("place"),
                        hit.bitwiseAND(F.lit(65535)).cast("int").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).cast("int").alias("state"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, walk,
                       lambda acc: acc["place"])


def _number(df: DataFrame, col: str) -> Column:
    """A number, date or time as an order-keeping number (double)."""
    kind = dict(df.dtypes)[col]
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def string_bounds(df: DataFrame, col: str, buckets: int) -> list[str]:
    """The values at which the buckets 1, 2, ... of a string column begin: the
    quantiles of all its rows that are not NULL."""
    values = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    values = written(values.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "values")
    # One number per partition: what comes before it.
    before, total = [], 0
    for r in values.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        before.append((r["part"], total))
        total += r["n"]
    if not total:
        return []
    running = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    ranked = (values.withColumn("upto", running)
                    .join(df.sparkSession.createDataFrame(before, "part int, before long"), "part")
                    .withColumn("upto", F.col("upto") + F.col("before")))
    # The number of bucket borders at or below the place of a value's last row.
    borders = F.floor((F.col("upto") - 1) * buckets / total) - F.floor((F.col("upto") - F.col("n") - 1) * buckets / total)
    found = ranked.filter((borders > 0) & (F.col("upto") > F.col("n"))).select("v")   # at most buckets - 1
    return sorted((r["v"] for r in found.collect()), key=str.encode)


def quantised(df: DataFrame, dims: Sequence[str], bits: int) -> list[Column]:
    """Bucket number of each dimension, by quantiles over all rows."""
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [c for c in dims if dict(df.dtypes)[c] != "string"]
    row = df.agg(*[F.percentile_approx(_number(df, c), cuts, 1000).alias(f"b{i}")
                   for i, c in enumerate(numbers)]).first() if numbers else ()
    out = []
    for c in dims:
        if c in numbers:
            value, bounds = _number(df, c), sorted(set(row[numbers.index(c)] or []))
        else:
            value, bounds = F.col(c), string_bounds(df, c, 1 << bits)
        # Buckets below the value: few bounds, compared inside code generation.
        n = sum((F.when(value >= F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0))
        out.append(F.coalesce(n, F.lit(0)).cast("int"))
    return out


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int,
                   ties: Sequence[str] = (), bits: int = 4) -> DataFrame:
    """``df`` with curve (place on the curve), shard (0 .. shards - 1, row
    counts at most one apart) and slot (gapless from 0 in the shard)."""
    own = set(df.columns)
    places = quantised(df, dims, bits)
    rows = df.select(F.struct("*").alias("row"), F.struct(*[F.col(c) for c in ties] or [F.lit(0)]).alias("ties"),
                     *[q.alias(f"q{i}") for i, q in enumerate(places)])
    placed = rows.select("row", "ties", curve_place([F.col(f"q{i}") for i in range(len(dims))], bits).alias("curve"))
    ordered = written(placed.repartitionByRange("curve", "ties").sortWithinPartitions("curve", "ties")
                            .withColumn("at", F.monotonically_increasing_id()), "curve")
    part = F.call_function("shiftright", F.col("at"), F.lit(33)).cast("int")
    ordered = ordered.withColumns({"part": part, "i": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    # One number per partition: the driver adds up the sizes before each.
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r["part"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(before, "part int, before long")
    shard = F.expr(f"cast(place * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    cut = (ordered.join(offsets, "part").withColumn("place", F.col("before") + F.col("i"))
                  .withColumn("shard", shard).withColumn("slot", F.col("place") - first))

    def free(name: str) -> str:
        while name in own | {"curve", "shard", "slot"}:
            name = f"own_{name}"
        return name
    return cut.select(*[F.col("row").getField(c).alias(free(c) if c in ("curve", "shard", "slot") else c)
                        for c in df.columns], "curve", "shard", "slot")


def document_metadata(docs: DataFrame) -> DataFrame:
    """The narrow rows sharding works on: id, size, text checksum, dimensions."""
    text = text_of("text")
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), "lang", "source")


def write_shards(df: DataFrame, path: str) -> None:
    """Files per shard in curve order, for pruning by min / max statistics; a
    large shard is written by many tasks."""
    (df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
       .write.partitionBy("shard").parquet(path))
