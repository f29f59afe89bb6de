"""Harmonic packing of tokenised documents into fixed-length sequences.

Lengths fall into reciprocal-capacity classes: class j holds the pieces longer
than capacity/(j+1) and at most capacity/j, and every bin of class j takes
exactly j pieces. A class therefore fills its bins by counting alone, with no
search and independently on every worker: a piece's bin is its number within
its class divided by j.

* Cutting: a document is cut into full sequences and a remainder. A remainder
  that would leave more than ``slack`` of its class's slot empty is cut at the
  next class's exact slot length, and so on with what is left (a few cuts, as
  what is left shrinks by a factor of about j each time). A document's cuts
  depend on its own length only, so one pass over the texts yields its pieces
  with their checksums.
* Numbering: each task numbers its pieces per class from 0; the pieces of
  earlier tasks are added from a table of counts (one row per task and class).
  No task sees all pieces of a class.
* Each class leaves at most one bin short of j pieces. The pieces of those
  bins number fewer than the sum of (j - 1) over the classes, a constant of
  the capacity (21,297 for 4096) whatever the input, and are packed
  best-fit, longest first.

Defined cases: NULL text counts as empty and is the end id alone. Rows that
repeat a doc_id are packed like any other row. An empty table gives an empty
result. A very long text is cut into as many pieces as it needs. Only the id and
the text are read; other columns may have any name.
"""

from __future__ import annotations

import bisect
import functools
import os
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.bpe import byte_letters
from meterline.llm.common import batch_of, map_rows, written

#: Words a worker remembers before it starts its table anew.
REMEMBERED = 1_000_000


class WordIds(dict):
    """Ids of whole texts for a vocabulary whose tokens never cross white
    space: each space-delimited word is encoded by the library once.

    A Latin word is handed to the library's merges directly, lower-cased, and
    apart from the ASCII marks that close it: the word pattern always breaks
    between a letter and a mark, and keeps marks that no letter follows in one
    piece. All other words take the library's whole way. ``plain`` has the
    lower-case forms that have not been met as words themselves.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = self.library.model
        self.letter_of = dict(enumerate(byte_letters()))
        self.plain: dict[str, bytes] = {}

    def _latin(self, key: str) -> bytes:
        letters = key if key.isascii() else key.encode().decode("latin-1").translate(self.letter_of)
        return np.array([t.id for t in self.merges.tokenize(letters)], "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        bare = word.rstrip(string.punctuation)
        if bare.isalpha() and (bare.isascii() or (max(bare) < "\u0250" and "\u0130" not in bare)):
            key = bare.lower()
            ids = self.get(key) or self.plain.get(key)
            if ids is None:
                ids = self._latin(key)
                if key != word and len(key) < 64:
                    if len(self.plain) >= REMEMBERED:
                        self.plain.clear()
                    self.plain[key] = ids
            if bare != word:
                ids += self[word[len(bare):]]
        else:
            ids = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


@functools.lru_cache(maxsize=100_000)
def cuts(n: int, capacity: int, slack: float) -> tuple[tuple[int, int, int], ...]:
    """(start, length, class) of the pieces of a document of ``n`` tokens."""
    full, rest = divmod(n, capacity)
    out = [(i * capacity, capacity, 1) for i in range(full)]
    at = full * capacity
    while rest:
        j = capacity // rest
        if rest >= (1 - slack) * (capacity // j):
            length = rest
        else:
            j += 1
            length = capacity // j
        out.append((at, length, capacity // length))
        at += length
        rest -= length
    return tuple(out)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "class int, part int, k long")


def cut_documents(docs: DataFrame, path: str, end_id: int, capacity: int,
                  slack: float) -> DataFrame:
    """The pieces of every document, numbered per (task, class)."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        ids_of, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for keys, texts in batches:
            out: list[list] = [[] for _ in range(8)]
            for key, text in zip(keys, texts):
                ids = memoryview(ids_of(text or "") + end)
                n = len(ids) // 4
                for start, length, j in cuts(n, capacity, slack):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    for col, v in zip(out, (key, start, length, crc, n, j, part, seen[j])):
                        col.append(v)
                    seen[j] += 1
            yield batch_of(**{name.split()[0]: (col, pa.int32() if name.endswith("int") else pa.int64())
                              for name, col in zip(PIECES.split(", "), out)})
    return map_rows(docs.select("doc_id", "text"), run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each piece: longest first, each into the fullest bin that
    still takes it."""
    free: list[tuple[int, int]] = []   # (room, bin), ascending
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(free, (lengths[i], -1))
        room, b = free.pop(at) if at < len(free) else (capacity, len(free))
        out[i] = b
        bisect.insort(free, (room - lengths[i], b))
    return out


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pieces (as ``cut_documents`` yields them) with sequence_id and offset.
    The pieces are written once: their numbering must not be computed twice."""
    pieces = written(pieces, "pieces")
    counts = pieces.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("n")
    # One row per class, `capacity` at most: its full bins and the first one's id.
    total, classes = 0, []
    for r in (counts.groupBy("class").agg(F.expr("sum(n) div class").alias("bins"))
                    .orderBy("class").collect()):
        classes.append((r["class"], r["bins"], total))
        total += r["bins"]
    first = pieces.sparkSession.createDataFrame(classes, "class int, bins long, first long")
    placed = (pieces.join(before, ["class", "part"]).join(F.broadcast(first), "class")
                    .withColumn("rank", F.col("before") + F.col("k"))
                    .withColumn("bin", F.expr("rank div class")))
    in_bin = Window.partitionBy("sequence_id").orderBy("slot")
    so_far = F.coalesce(F.sum("length").over(
        in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    full = (placed.filter("bin < bins")
                  .withColumn("sequence_id", F.col("first") + F.col("bin"))
                  .withColumn("slot", F.expr("rank % class"))
                  .withColumn("offset", so_far).select(*cols))

    def fit(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "doc_id", "start"], ascending=False).reset_index(drop=True)
        rest["sequence_id"] = total + np.array(best_fit(rest["length"].tolist(), capacity), "int64")
        rest["offset"] = rest.groupby("sequence_id")["length"].cumsum() - rest["length"]
        return rest

    # Ids as text: pandas would turn a column of numbers and NULLs into floats.
    narrow = [F.lit(0).alias("all"), F.col("doc_id").cast("string").alias("doc_id"), "start", "length",
              "ids_crc32", "doc_tokens"]
    rest = (placed.filter("bin >= bins").select(*narrow).groupBy("all").applyInPandas(
        fit, "all int, doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long"))
    return full.unionByName(rest.withColumn("doc_id", F.col("doc_id").cast("long")).select(*cols))


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096,
                   slack: float = 0.02) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    return pack(cut_documents(docs, path, end_id, capacity, slack), capacity)
