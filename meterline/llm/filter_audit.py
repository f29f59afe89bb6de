"""Filter interaction audit by forward-backward path counting.

k filters applied in some order walk through the lattice of their subsets: a
state is the set already applied, an edge adds one filter, an order is a path
from the empty set to the full one. Rows are reduced to one number, the set of
filters that they fail, and counted by (part, that set, label). On those counts:

* ``alive(S)``, the rows failing nothing in S, for all S at once (subset sums,
  one bit after the other); edge S -> S+f removes ``alive(S) - alive(S+f)``.
* Forward counting gives the orders that reach S, backward counting those that
  lead on from S+f. An edge lies on the product of both, and its removals
  weighted by that sum to f's Shapley figure.
* The steps of each order are read from the same edges.

Scale: one scan cuts each text to a row of about 70 bytes (id, part, SHA-256,
failed set), stored once. A filter given as ``COPIES`` fails rows whose text
some smaller id has: the smallest id per text is a partial aggregate, and the
join back is split by adaptive execution where one text holds much of the data.
Everything after is counts: 2^k failed sets per part and label, one task per
part. The list of orders has k! entries, so keep k small; ``edges`` has k 2^k.

Defined cases: a NULL text counts as empty, a NULL part as the empty string. A
condition that is NULL does not fail its row. Texts are equal when their
SHA-256 is. A NULL id is neither smaller nor larger than any. Rows that repeat
id and text count each, none of them a copy of the other. An id labelled more
than once has every label that any of its rows has; NULL labels are none. Empty
tables give an empty result. Very long texts are one row like any other. Only
the named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_of, written

#: Stands for the condition "some smaller id has the same text".
COPIES = "copies"


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and 9 to 13."""
    return F.array_remove(F.split(text, r"[ \x09-\x0D]+"), "")


def _bits(conditions: dict[int, Column]) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.when(c, 1 << i).otherwise(0) for i, c in conditions.items()], F.lit(0))


def failed_sets(docs: DataFrame, filters: dict[str, Column | str], part: Column,
                id_col: str, text_col: str) -> DataFrame:
    """One row per row: id, part, fails (bit i: the i-th filter fails it).
    Conditions see the columns text (never NULL) and words, and no others."""
    plain = {i: c for i, c in enumerate(filters.values()) if not isinstance(c, str)}
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(part, F.lit("")).alias("part"),
                       text_of(text_col).alias("text"))
    rows = text.withColumn("words", words(F.col("text"))).select(
        "id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        _bits(plain).alias("fails"))
    copies = [i for i, c in enumerate(filters.values()) if isinstance(c, str)]
    if not copies:
        return rows.drop("sha")
    rows = written(rows, "audited")
    # Texts of more than one row only, stored: the join is then between two plain
    # shuffles, which adaptive execution may split at a hot text.
    first = written(rows.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").drop("n"), "first")
    later = _bits({i: F.col("id") > F.col("first") for i in copies})
    return rows.join(first, "sha", "left").select("id", "part", (F.col("fails") + later).alias("fails"))


def counted(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | str], part: Column,
            lost: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, fails, n, and per entry of ``lost`` (a condition on the label rows)
    how many of the n have that label: at most 2^k rows a part."""
    flags = [F.coalesce(F.max(F.coalesce(c, F.lit(False)).cast("int")), F.lit(0)).alias(f"l{i}")
             for i, c in enumerate(lost.values())]
    known = labels.groupBy(F.col(id_col).alias("id")).agg(*flags)
    rows = failed_sets(docs, filters, part, id_col, text_col).join(known, "id", "left")
    return rows.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(F.col(f"l{i}"), F.lit(0))).alias(f"l{i}") for i in range(len(lost))])


def paths(k: int) -> tuple[list[int], list[int]]:
    """Orders reaching each state, and orders leading from it to the full set."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):
        for f in range(k):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(k):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def alive(counts: np.ndarray, k: int) -> np.ndarray:
    """Of the counts by failed set (last axis): for each state, the rows that
    fail nothing in it."""
    out = counts.copy()
    for f in range(k):
        pairs = out.reshape(*out.shape[:-1], -1, 2, 1 << f)
        pairs[..., 1, :] += pairs[..., 0, :]
    return out[..., ::-1]   # index S held the sums over subsets of S


def edges_of(counts: np.ndarray, k: int) -> Iterator[tuple[int, int, dict]]:
    """(state, filter, figures) of every edge; ``counts``: all rows, then one
    line per label, by failed set."""
    left = alive(counts, k)
    forward, backward = paths(k)
    for state in range(1 << k):
        for f in range(k):
            if not state >> f & 1:
                gone = left[:, state] - left[:, state | 1 << f]
                failing = int(left[0, 0] - left[0, 1 << f])
                yield state, f, {"kept": int(left[0, state | 1 << f]), "removed": int(gone[0]),
                                 "redundant": failing - int(gone[0]),
                                 "unique_fails": int(counts[0, 1 << f]),
                                 "lost": [int(x) for x in gone[1:]],
                                 "orders": forward[state] * backward[state | 1 << f]}


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | str], part: Column,
          lost: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order (the
    filters' names, joined), step, kept, removed, redundant, unique_fails, one
    column per entry of ``lost``, shapley (the step's filter's removals summed
    over all orders)."""
    names, k, sides = list(filters), len(filters), ["n", *(f"l{i}" for i in range(len(lost)))]
    figures = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(sides), 1 << k), "int64")
        for i, c in enumerate(sides):
            counts[i, rows["fails"]] = rows[c]
        edges = {(s, f): e for s, f, e in edges_of(counts, k)}
        shapley = [sum(e["removed"] * e["orders"] for (_, g), e in edges.items() if g == f)
                   for f in range(k)]
        out = []
        for order in permutations(range(k)):
            state, label = 0, "".join(names[f] for f in order)
            for step, f in enumerate(order, 1):
                e = edges[state, f]
                out.append((rows["part"].iloc[0], label, step, e["kept"], e["removed"],
                            e["redundant"], e["unique_fails"], *e["lost"], shapley[f]))
                state |= 1 << f
        return pd.DataFrame(out, columns=["part", "filter_order", "step", *figures])

    return counted(docs, labels, filters, part, lost, id_col, text_col).groupBy("part").applyInPandas(
        steps, "part string, filter_order string, step int, "
               + ", ".join(f"`{c}` long" for c in figures))


def document_filters() -> dict[str, Column | str]:
    """The five failure conditions of the registered query."""
    text, n = F.col("text"), F.size("words")
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct("words")) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
        "E": COPIES,
    }
