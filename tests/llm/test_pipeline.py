"""run() against a plain Python version of the five stages."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from meterline.llm import packing, quality, toxicity
from meterline.llm.common import fold
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, stored
from tests.llm.test_simhash import plain_components, plain_fingerprint

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = quality.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 4) != 2)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r in rows if field.score(r[1]) >= 0.3 and model.score(r[1]) < 0.3]
    best = {}
    for i, t in rows:
        key = (t or "").translate(UPPER)
        if key not in best or (i is not None and (best[key][0] is None or i > best[key][0])):
            best[key] = (i, t)
    rows = list(best.values())
    low = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    rows = [r for r, (i, _, c) in zip(rows, low) if i == c]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out += [(i, s, n, zlib.crc32(ids[s:s + n].tobytes()), len(ids))
                for s, n, _ in packing.cuts(len(ids), 4096, 0.02)]
    return sorted(out, key=repr)


def got(df):
    rows = df.collect()
    load = {}
    for r in rows:
        load.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in load.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 4096
    return sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
                   for r in rows), key=repr)


def test_run_equals_the_plain_version(spark):
    assert got(P.run(spark, SF001)) == expected(spark, SF001)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns, name


def test_awkward_and_empty_documents(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    at = stored(spark, "pipe", documents=awkward(spark), labels=labels)
    # The labelled ids are those of the awkward rows: every outcome is defined.
    out = P.run(spark, at)
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in awkward(spark).collect()}
    none = stored(spark, "pipe0", documents=empty(spark), labels=labels.limit(0))
    assert P.run(spark, none).count() == 0
