"""Exact deduplication by content hash, with a byte comparison (native only).

Rows whose texts are equal after lower-casing A-Z form a group; one row of each
group stays. The work is done on narrow rows (id, 128-bit hash):

1. Count rows per (hash, id), then per hash: partial aggregation collapses the
   copies of a hot text on the map side.
2. Bytes are compared inside every group of more than one row: each member's
   text is joined with the text of the row that stays. A large group's members
   are dealt by a salt, as many as its size asks for (``TOGETHER`` rows each),
   and only the text that stays is repeated per salt.
3. Hashes whose members differ (a collision) are grouped again by the text
   itself, so a collision can neither drop nor merge a row.

Defined cases: a NULL text counts as empty. A NULL id is smaller than every id
and stays only if its group has no other. Rows that repeat the id that stays
and its text: one of them stays, in ``drop_copies`` the one whose columns are the
smallest as JSON. An empty table gives an empty result. Other columns, whatever
their names, are not read by ``exact_groups`` and passed on by ``drop_copies``.
Very long texts take part whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import ascii_lower, text_of, written

#: Members of a group whose bytes are compared in one task.
TOGETHER = 4096


def content_hash(text: Column) -> Column:
    """128-bit hash of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _groups(per_id: DataFrame, by: list[str], keep: str) -> DataFrame:
    """Per group: the id that stays and the number of rows."""
    best = {"largest": F.max, "smallest": F.min}[keep]
    # A NULL id loses under either rule.
    order = F.struct(F.col("id").isNull().alias("none") if keep == "smallest"
                     else F.col("id").isNotNull().alias("some"), F.col("id"))
    return per_id.groupBy(*by).agg(best(order).alias("b"), F.sum("n").alias("size")) \
                 .select(*by, F.col("b.id").alias("keep"), "size")


def _flagged(per_id: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """One row per input row: id, keep, size, kept, the group's columns."""
    return (per_id.join(groups, by)
                  .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
                  .withColumn("kept", F.col("id").eqNullSafe(F.col("keep")) & (F.col("i") == 1))
                  .drop("i", "n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "largest",
                 hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: id, keep (the id that stays), size (rows of
    the group), kept, sha (SHA-256 of the normalised text, hex). ``keep``:
    'largest' or 'smallest' id."""
    norm = ascii_lower(text_of(text_col))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm")) \
                .withColumns({"h": hash_of(F.col("norm")), "part": F.spark_partition_id()})
    per_id = written(
        texts.select("id", "h", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"))
             .groupBy("h", "id").agg(F.count(F.lit(1)).alias("n"), F.max("sha").alias("sha")),
        "hashes")
    # Stored: the joins below are then between plain shuffles, which adaptive
    # execution may split at a hot hash.
    groups = written(_groups(per_id, ["h"], keep), "groups")
    salts = F.ceil(F.col("size") / TOGETHER).cast("int")
    several = groups.filter("size > 1").select("h", "keep", salts.alias("salts"))
    members = texts.join(several, "h")
    # Dealt anew by hash: the join before is then free to be split where one
    # hash holds much of the data, as it is for the salted join below.
    stays = (members.filter(F.col("id").eqNullSafe(F.col("keep"))).select("h", "norm", "salts")
                    .repartition("h").groupBy("h", "salts").agg(F.min("norm").alias("kept_text"))
                    .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    salted = members.select("h", "norm", F.pmod(F.xxhash64("id", "part"), F.col("salts"))
                            .cast("int").alias("salt"))
    clash = written(salted.join(stays, ["h", "salt"]).filter("norm != kept_text").select("h").distinct(),
                    "clashes")
    if clash.isEmpty():
        return _result(_flagged(per_id, groups, ["h"]))
    sound = per_id.join(clash, "h", "left_anti")
    # The texts of clashing hashes, counted by the bytes themselves.
    apart = (texts.join(clash, "h").groupBy("h", "norm", "id").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("sha", F.unhex(F.sha2(F.col("norm").cast("binary"), 256))))
    return _result(_flagged(sound, groups, ["h"])).unionByName(
        _result(_flagged(apart, _groups(apart, ["h", "norm"], keep), ["h", "norm"])))


def _result(flagged: DataFrame) -> DataFrame:
    return flagged.select("id", "keep", "size", "kept", F.lower(F.hex("sha")).alias("sha"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    flags = exact_groups(docs, id_col, text_col, keep).filter("kept").select("id", F.col("sha").alias("own"))
    own = F.sha2(ascii_lower(text_of(text_col)).cast("binary"), 256)
    return one_row_each(docs, id_col, own, flags)


def one_row_each(docs: DataFrame, id_col: str, own: Column, stay: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and ``own`` are among ``stay`` (id, own), one
    of each: the smallest as JSON. All columns travel inside one struct, so they
    may have any names. Only pairs that occur more than once are compared."""
    rows = docs.select(F.col(id_col).alias("id"), own.alias("own"), F.struct("*").alias("row"))

    def same(other: DataFrame) -> Column:
        return rows["id"].eqNullSafe(other["id_"]) & (rows["own"] == other["own_"])
    stay = stay.select(F.col("id").alias("id_"), F.col("own").alias("own_"))
    rows = rows.join(stay, same(stay), "left_semi")
    again = (rows.groupBy(F.col("id").alias("id_"), F.col("own").alias("own_"))
                 .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    once = rows.join(again, same(again), "left_anti").select("row")
    firsts = (rows.join(again, same(again), "left_semi").groupBy("id", "own")
                  .agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return once.unionByName(firsts).select("row.*")
