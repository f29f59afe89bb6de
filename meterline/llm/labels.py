"""Labelled rows for the classifiers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import batch_of, map_rows, written

Model = TypeVar("Model")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column,
                    rows: int) -> DataFrame:
    """doc_id, text, label of at most ``rows`` labelled documents that ``train``
    (a condition on the label rows) admits, chosen by a hash of the id. A
    document labelled more than once counts once, with its smallest label, and
    an id on many rows once, with the text of the smallest hash; NULL ids, labels
    and texts are not used. The sample's bound makes the broadcast safe."""
    picked = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).filter(train)
                    .groupBy("doc_id").agg(F.min(label).alias("label"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # Partial aggregates: however often an id repeats, a task sends one row of it.
    return (docs.select("doc_id", "text").filter("text is not null")
                .join(F.broadcast(picked), "doc_id")
                .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
                .select("doc_id", "least.text", "label"))


def fitted(sample: DataFrame, fit: Callable[[list[tuple[str, int]]], Model]) -> Model:
    """What ``fit`` makes of a ``labelled_sample``'s (text, label) rows. It runs
    in one task, which the sample's bound allows; only the model reaches the
    driver."""
    rows = written(sample.select("text", "label"), "sample")

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        got = sorted((text, int(y)) for texts, ys in batches for text, y in zip(texts, ys))
        yield batch_of(model=([pickle.dumps(fit(got))], pa.binary()))
    row = map_rows(rows.repartition(1), run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([])
