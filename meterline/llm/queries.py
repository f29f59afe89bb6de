"""The registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (bpe, chat, exact_dedup, filter_audit, hilbert, neighbours, packing, quality,
                           simhash, suffix_tree, topk, toxicity, whitening)
from meterline.llm.common import fold, small_batches, table

#: A document counts as label 1 from this score on.
THRESHOLD = 0.3


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose turns hold control strings, read back
    from the formatted prefix trees."""
    small_batches(spark)
    odd = spark.createDataFrame([(-1, i, r, "</s>[INST] ok [/INST]") for i, r in
                                 enumerate(("user", "assistant"))],
                                "conv_id long, turn long, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.prefix_forest(talks.unionByName(odd), path), path)


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every vector whose id 20 divides."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def _scored(scores: DataFrame, folds: int, held: int) -> DataFrame:
    return scores.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; fold 0 of 5 is held out of training."""
    small_batches(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = quality.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return _scored(quality.score_documents(docs, field), 5, 0)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text decoded from them, as digests."""
    small_batches(spark)
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; fold 2 of 7 is not learnt."""
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    small_batches(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


def op9_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards cut from the Hilbert order of (lang, source, size)."""
    docs = hilbert.document_metadata(table(spark, sf_dir, "documents"))
    out = hilbert.hilbert_shards(docs, ["lang", "source", "size"], 8,
                                 ties=["text_crc32", "size", "doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fold 2 of 4 is held out of training."""
    small_batches(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 4) != 2)
    return _scored(toxicity.score_documents(docs, model), 4, 2)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents in all 120 orders, by language."""
    return filter_audit.audit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        filter_audit.document_filters(), F.col("lang"),
        {"good_lost": F.col("quality") == 1, "toxic_lost": F.col("toxic") == 1})


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every vector whose id 100 divides."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 16 whitened components of all distinct ones."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_neighbours": op2_neighbours,
    "op3_quality": op3_quality,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash": op7_simhash,
    "op8_harmonic_packing": op8_harmonic_packing,
    "op9_hilbert_sharding": op9_hilbert_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_exact_topk": op12_exact_topk,
    "op13_whitening": op13_whitening,
}

LLM_ORACLE = {
    "op6_exact_dedup": """
        WITH t AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS norm
          FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t""",
    "op11_filter_audit": r"""
        WITH d AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                 list_filter(regexp_split_to_array(coalesce(text, ''), '[ \x09-\x0D]+'),
                             lambda w: w <> '') AS words
          FROM documents),
        l AS (
          SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good,
                 coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
          FROM labels GROUP BY doc_id),
        failed AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                 CAST(len(words) < 100 AS INT) AS a,
                 CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT) AS b,
                 CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))
                      > 10 * length(text) AS INT) AS c,
                 CAST(regexp_matches(text, '[#$%&*|]') AS INT) AS d,
                 coalesce(CAST(d.doc_id > min(d.doc_id) OVER (PARTITION BY text) AS INT), 0) AS e
          FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
        sets AS (
          SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS fails, count(*) AS n,
                 sum(good) AS good, sum(toxic) AS toxic
          FROM failed GROUP BY ALL),
        f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
          SELECT f1.letter || f2.letter || f3.letter || f4.letter || f5.letter AS filter_order,
                 [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits
          FROM f f1, f f2, f f3, f f4, f f5
          WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31
            AND (f1.bit | f2.bit | f3.bit | f4.bit | f5.bit) = 31),
        steps AS (
          SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
          FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
        done AS (
          SELECT part, filter_order, step, bit,
                 sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
                 sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
                 sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant,
                 sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost,
                 sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
          FROM sets, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM done""",
    "op12_exact_topk": """
        WITH v AS (
          SELECT vec_id, min(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          GROUP BY vec_id),
        w AS (
          SELECT vec_id, list_transform(e, lambda x: CAST(floor(1024 * x) AS BIGINT)) AS x FROM v),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(coalesce(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])), 0)
                      AS BIGINT) AS score
          FROM w q JOIN w c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 10""",
}
