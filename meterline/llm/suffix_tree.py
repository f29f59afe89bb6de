"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of zero, one or two words. The root predicts words by their
counts plus one. A context of at least ``MIN_CONTEXT`` occurrences is kept as a
state only if a divergence test passes: its next-word counts must predict
themselves, each occurrence left out in turn, better than its longest kept
suffix does, by more than ``TEST`` nats in all. A kept state's distribution is
smoothed towards its suffix's, (n + k P) / (N + k); a word is scored by the
longest state that is a suffix of what precedes it. A text begins after the end
of another, so the end mark is the first word's context.

States tell apart the words of at least ``MIN_SYMBOL`` occurrences and one
class of all others; within that class words keep the root's proportions. All
distributions sum to one over the known words and one unknown. Both floors are
fixed numbers, so the model grows with the corpus.

Counting and scoring move no tokens. Texts are cut into blocks of about
``BLOCK`` tokens, each kept as one packed row, and a block asks only for the
totals of the distinct keys in it: its keys are dealt over buckets by their
hash, a bucket sums them over all blocks and sends each block its totals. So a
key that fills the corpus is one entry per block, and each bucket holds about
``ENTRIES`` entries whatever the input. This is done three times: words, pairs
(context, word) and triples. Whether a context is kept comes back the same way:
a block asks the buckets for its own contexts. Words and keys are 64-bit hashes.
The driver gets a few sums and no keys.

The disk holds little beyond one table of blocks at a time. Blocks are kept in
``TURNS`` folders and buckets summed in ``RANGES``; a step goes through them
one after the other, and the shuffle files of a turn or range, the rows that a
turn has used and the totals it was sent are removed before the next.

Defined cases: NULL texts are empty (their end mark is their one token); NULL
ids are training rows; repeated rows all count; without training rows every
base probability is 1 / 1. An empty table gives an empty result. Very long texts
are scored whole (a block ends after the text that fills it). Only the two named
columns and those of the ``held`` condition are read; others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import (ARROW_ROWS, batch_of, batch_rows, map_rows, setting,
                                  small_batches)
from meterline.operators.incremental import delete_path
from meterline.session import scratch_path

BLOCK = 1_500_000
ENTRIES = 400_000
#: Occurrences that a context and a symbol need, whatever the corpus.
MIN_CONTEXT = 64
MIN_SYMBOL = 8
#: Share of the training tokens that a context needs besides: none (the floors'
#: definition in the tests names it).
SHARE = 0.0
#: Weight of the suffix's distribution in a state's, by context length.
PRIOR = (0.0, 60.0, 20.0)
#: Gain in nats that a context must show to be kept.
TEST = 8.0
SEED = 17
#: Folders that blocks are dealt to.
TURNS = 8
#: Ranges of buckets summed one by one, for words, pairs and triples: each range
#: reads the blocks again, and fewer ranges leave more shuffled at once.
RANGES = {"words": 2, "pairs": 6, "triples": 8}
#: A query's shuffle files go when it ends (its table is written by then).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Packed blocks are heavy work in few bytes: shuffled rows a task takes at once.
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m"
END = np.uint64(xxhash.xxh64_intdigest(b"", SEED))
RARE = np.uint64(xxhash.xxh64_intdigest(b" ", SEED))


def pack(a: np.ndarray) -> bytes:
    """An array's bytes, plane by plane (all first bytes, then all second ones,
    ...), compressed: high bytes of small numbers shrink to nothing."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(a.view("u1").reshape(-1, a.itemsize).T.tobytes(), 1)


def unpack(b: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), "u1").reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, "<u8"), dtype="u8")


def halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What keys add to a mixed key as its first and as its second part."""
    return (keys * np.uint64(0x9E3779B97F4A7C15),
            (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9))


def stirred(x: np.ndarray) -> np.ndarray:
    """A key of the sum of two halves, in the place of the sum."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key of two (not symmetric)."""
    return stirred(halves(a)[0] + halves(b)[1])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys ascending, where one of each is, and each key's place
    among them (``np.unique`` sorts stably for this, several times slower)."""
    order = np.argsort(keys)
    ascending = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    at = np.empty(len(keys), "i8")
    at[order] = np.cumsum(new) - 1
    return ascending[new], order[new], at


# --- blocks ---------------------------------------------------------------

BLOCKS = ("block long, doc_ids array<long>, lens binary, held binary, ids binary, keys binary, "
          "counts binary, end_at long, n_keys long, n_tokens long, n_train long")


def _block_row(number: int, doc_ids: list, lens: np.ndarray, held: list[bool],
               tokens: list[pa.Array]) -> pa.RecordBatch:
    """A block: its words' keys ascending, its tokens as places among them. The
    empty token is the end mark."""
    coded = pa.concat_arrays([pa.array([""], pa.large_string()), *tokens]).dictionary_encode()
    local = coded.indices.to_numpy()[1:]
    ends, text = (np.frombuffer(b, t) if b else np.zeros(0, t) for b, t in
                  zip(coded.dictionary.buffers()[1:], ("<i8", "u1")))
    text, ends = text.tobytes(), ends[coded.dictionary.offset:][:len(coded.dictionary) + 1].tolist()
    keys = np.array([xxhash.xxh64_intdigest(text[i:j], SEED) for i, j in zip(ends, ends[1:])], "<u8")
    train = np.repeat(~np.array(held, bool), lens)
    order = np.argsort(keys)
    place = np.empty(len(order), "<u4")
    place[order] = np.arange(len(order))
    counts = np.bincount(local[train], minlength=len(keys))[order].astype("<u4")
    return batch_of(block=([number], pa.int64()), doc_ids=([doc_ids], pa.list_(pa.int64())),
                    lens=([pack(lens.astype("<u4"))], pa.binary()),
                    held=([pack(np.array(held, "u1"))], pa.binary()),
                    ids=([pack(place[local])], pa.binary()), keys=([pack_keys(keys[order])], pa.binary()),
                    counts=([pack(counts)], pa.binary()), end_at=([int(place[0])], pa.int64()),
                    n_keys=([len(keys)], pa.int64()), n_tokens=([len(local)], pa.int64()),
                    n_train=([int(train.sum())], pa.int64()))


def tokens_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts one after the other, and each text's number of them.
    A blank after a text's last word makes the end mark, as an empty text does."""
    bare = ((text or "").encode().lower().strip() for text in texts)   # A-Z and ASCII blanks only
    ended = pa.array([b + b" " if b else b for b in bare], pa.large_binary())
    split = pc.ascii_split_whitespace(ended.cast(pa.large_string()))
    return split.flatten(), pc.list_value_length(split).to_numpy()


def blocks_of(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        doc_ids, lens, out, words = [], [], [], []
        for keys, texts, held_out in batches:
            tokens, counts = tokens_of(texts)
            ends, at = np.concatenate([[0], np.cumsum(counts)]), 0
            while at < len(keys):
                # Up to the text that fills the block, or all that are left.
                to = min(int(np.searchsorted(ends, ends[at] + BLOCK - size)), len(keys))
                doc_ids += keys[at:to]
                lens.append(counts[at:to])
                out += map(bool, held_out[at:to])
                words.append(tokens[ends[at]:ends[to]])
                size += int(ends[to] - ends[at])
                at = to
                if size >= BLOCK:
                    yield _block_row((part << 24) + made, doc_ids, np.concatenate(lens), out, words)
                    made, size = made + 1, 0
                    doc_ids, lens, out, words = [], [], [], []
        if doc_ids:
            yield _block_row((part << 24) + made, doc_ids, np.concatenate(lens), out, words)
    return map_rows(docs.select(id_col, text_col, held.alias("held")), run, BLOCKS)


# --- turns --------------------------------------------------------------------

def turn_of(block: Column) -> Column:
    """A task's blocks go round the turns, each task's from another start."""
    return (F.when(block < 0, -1)
             .otherwise(F.pmod(block + F.shiftright(block, 24), F.lit(TURNS))).cast("int"))


def by_turn(df: DataFrame, path: str) -> None:
    """Write rows of blocks to a folder per turn."""
    (df.withColumn("turn", turn_of(F.col("block")))
       .write.partitionBy("turn").parquet(path))


def of_turns(spark: SparkSession, path: str, schema: str, more: str = "") -> DataFrame:
    """The rows under ``path`` that are still there, with their ``turn``."""
    return spark.read.schema(f"{schema}, turn int{more}").parquet(path)


def in_turn(df: DataFrame, turn: int) -> DataFrame:
    return df.filter(F.col("turn") == turn)


def bounds(buckets: int) -> np.ndarray:
    """The least key of each bucket."""
    return np.array([-(-(i << 32) // buckets) << 32 for i in range(buckets)], "<u8")


# --- totals of keys over all blocks -----------------------------------------

Summary = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, ...]]
DEALT = ("bucket int, block long, keys binary, counts binary, contexts binary, context binary, "
         "lp binary")


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key: equal ranges of its upper 32 bits."""
    return F.shiftright(F.shiftrightunsigned(key, 32) * F.lit(buckets).cast("long"), 32).cast("int")


def dealt(block: int, keys: np.ndarray, counts: np.ndarray | None, ctx: np.ndarray | None,
          lp: np.ndarray | None, buckets: int, span: tuple[int, int] | None = None) -> pa.RecordBatch:
    """A block's entries, keys ascending, one row per bucket (``bucket_of``) of
    ``span`` (first, end): buckets are equal ranges of the keys, so a block's
    totals come back in the order of its keys."""
    starts = np.append(np.searchsorted(keys, bounds(buckets)), len(keys))
    used = np.flatnonzero(np.diff(starts))
    if span:
        used = used[(used >= span[0]) & (used < span[1])]
    out: list[list] = [[] for _ in range(5)]
    for p in used:
        at = slice(starts[p], starts[p + 1])
        out[0].append(pack_keys(keys[at]))
        if counts is not None:
            out[1].append(pack(counts[at].astype("<u4")))
        if ctx is not None:
            own, _, place = distinct(ctx[at])
            out[2].append(pack_keys(own))
            out[3].append(pack(place.astype("<u4")))
            out[4].append(pack(lp[at].astype("<f4")))
    out = [c or [None] * len(used) for c in out]
    return batch_of(bucket=(used, pa.int32()), block=([block] * len(used), pa.int64()),
                    keys=(out[0], pa.binary()), counts=(out[1], pa.binary()),
                    contexts=(out[2], pa.binary()), context=(out[3], pa.binary()), lp=(out[4], pa.binary()))


SUMS = "block long, bucket int, part binary, often binary, keys binary, a binary, b binary"
Span = tuple[int, int]


def totals(spark: SparkSession, entries: Callable[[Span], DataFrame], buckets: int,
           name: str, summary: Summary, often: int = 0) -> tuple[DataFrame, DataFrame, str]:
    """The totals of the blocks' keys by block and bucket, and the keys whose
    total reaches ``often``; the rows of ``summary``: key, a, b; and the folder
    of both. ``entries``: rows of ``dealt`` for a span of buckets."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_keys(b) for b in rows["keys"]]
        met, first, at = distinct(np.concatenate(keys))
        total = np.bincount(at, np.concatenate([unpack(b, "<u4") for b in rows["counts"]]))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        split = np.split(total[at], cuts)
        ctx = lp = None
        if rows["context"].iloc[0] is not None:
            ctx = np.concatenate([unpack_keys(a)[unpack(b, "<u4")] for a, b in
                                  zip(rows["contexts"], rows["context"])])[first]
            lp = np.concatenate([unpack(b, "<f4") for b in rows["lp"]])[first].astype(float)
        key, a, b = summary(met, total, ctx, lp)
        blank = [None] * len(split)
        out = pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"],
                            "part": [pack(t.astype("<u8")) for t in split],
                            "often": [pack_keys(k[t >= often]) for k, t in zip(keys, split)]
                            if often else blank,
                            "keys": blank, "a": blank, "b": blank})
        more = pd.DataFrame({"block": [-1], "bucket": [int(rows["bucket"].iloc[0])], "part": [None],
                             "often": [None], "keys": [pack(key.astype("<u8"))],
                             "a": [pack(a.astype("<f8"))], "b": [pack(b.astype("<f8"))]})
        return pd.concat([out, more], ignore_index=True)

    small_batches(spark)
    path, ranges = scratch_path(spark, f"llm-{name}-totals"), RANGES[name]
    for i in range(ranges):
        span = (buckets * i // ranges, buckets * (i + 1) // ranges)
        by_turn(entries(span).groupBy("bucket").applyInPandas(add, SUMS), f"{path}/span={i}")
    summed = of_turns(spark, path, SUMS, ", span int")

    def spread(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for key, a, b in zip(*rows):
                yield batch_of(key=(unpack(key, "<u8").view("<i8"), pa.int64()),
                               a=(unpack(a, "<f8"), pa.float64()), b=(unpack(b, "<f8"), pa.float64()))
    rest = map_rows(in_turn(summed, -1).select("keys", "a", "b"), spread,
                    "key long, a double, b double")
    return summed, rest, path


def parts_of(summed: DataFrame, turn: int) -> DataFrame:
    """(block, parts: its totals by bucket) of a turn's blocks."""
    return (in_turn(summed, turn).groupBy("block")
            .agg(F.sort_array(F.collect_list(F.struct("bucket", "part", "often"))).alias("parts")))


def collected(parts: list[dict] | None) -> np.ndarray:
    """A block's totals in the order of its keys."""
    return np.concatenate([unpack(p["part"], "<u8") for p in parts or []] or [np.empty(0)]).astype(float)


def word_entries(blocks: DataFrame, buckets: int, span: Span) -> DataFrame:
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, keys, counts in zip(*rows):
                yield dealt(block, unpack_keys(keys), unpack(counts, "<u4"), None, None, buckets, span)
    return map_rows(blocks.select("block", "keys", "counts"), run, DEALT)


# --- the three rounds ---------------------------------------------------------

def log_state(n: np.ndarray, total: np.ndarray, prior: float, lp: np.ndarray) -> np.ndarray:
    """Log-probability in a state from its counts and its suffix's."""
    return np.log(n + prior * np.exp(lp)) - np.log(total + prior)


def leave_one_out(prior: float) -> Summary:
    """Per context: the sum of n log((n - 1) / P + k), and of n."""
    def summary(_: np.ndarray, n: np.ndarray, ctx: np.ndarray, lp: np.ndarray) -> tuple[np.ndarray, ...]:
        seen = n > 0
        n, lp = n[seen], lp[seen]
        keys, _, at = distinct(ctx[seen])
        gain = n * np.log((n - 1) * np.exp(-lp) + prior)
        return keys, np.bincount(at, gain, len(keys)), np.bincount(at, n, len(keys))
    return summary


def kept_contexts(gains: DataFrame, prior: float) -> DataFrame:
    """key of the contexts that pass the divergence test."""
    return (gains.groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("n"))
                 .filter((F.col("n") > 1) & (F.col("a") - F.col("n") * F.log(F.col("n") - 1 + prior) > TEST))
                 .select("key"))


def among(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)
    return sorted_set[at] == keys


FLAGS = "block long, flags array<struct<bucket: int, flags: binary>>"


def kept_flags(asked: DataFrame, kept: DataFrame, buckets: int) -> DataFrame:
    """(block, flags: by bucket whether each key that the block asks for is
    among the kept contexts). ``asked``: rows of ``dealt``, keys alone."""
    def mark(asks: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        have = np.sort(known["key"].to_numpy("<i8").view("<u8"))
        return pd.DataFrame({"block": asks["block"], "bucket": asks["bucket"],
                             "flags": [pack(among(unpack_keys(b), have).astype("u1"))
                                       for b in asks["keys"]]})

    known = kept.select(bucket_of(F.col("key"), buckets).alias("bucket"), "key")
    return (asked.select("bucket", "block", "keys").groupBy("bucket")
                 .cogroup(known.groupBy("bucket"))
                 .applyInPandas(mark, "block long, bucket int, flags binary")
                 .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "flags"))).alias("flags")))


def flagged(flags: list[dict] | None) -> np.ndarray:
    """A block's flags in the order of the keys it asked for."""
    return np.concatenate([unpack(f["flags"], "u1") for f in flags or []] or [np.empty(0)]).astype(bool)


PAIRS = ("block long, doc_ids array<long>, lens binary, held binary, n_known binary, base binary, "
         "rest binary, symbols binary, symbol_keys binary, symbol_lp binary, symbol_n binary")


def symbol_round(blocks: DataFrame, words: DataFrame, n: int, v: int, rare_mass: float,
                 min_symbol: int) -> DataFrame:
    """Base scores, and the tokens as symbols: 0 the end mark, 1 the rare class,
    then the block's frequent words, the most frequent first."""
    size = n + v + 1.0

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, doc_ids, lens_b, held_b, ids, end, parts in zip(*rows):
                lens, local = unpack(lens_b, "<u4").astype("i8"), unpack(ids, "<u4").astype("i8")
                c = collected(parts)
                lp = np.log((c + 1) / size)
                doc = np.repeat(np.arange(len(lens)), lens)
                n_known = np.bincount(doc[c[local] > 0], minlength=len(lens))
                base = np.bincount(doc, lp[local], len(lens))
                often = np.flatnonzero(c >= min_symbol)
                keys = np.concatenate([unpack_keys(p["often"]) for p in parts])
                keys, often = keys[often != end], often[often != end]
                order = np.argsort(-c[often], kind="stable")
                keys, often = keys[order], often[order]
                number = np.ones(len(c), "i8")
                number[often] = np.arange(2, 2 + len(often))
                number[end] = 0
                lp_rare = math.log(rare_mass / size)
                symbols = number[local]
                # What a rare word costs beyond its class, in whatever state.
                rest = np.bincount(doc, np.where(symbols == 1, lp[local] - lp_rare, 0.0), len(lens))
                yield batch_of(
                    block=([block], pa.int64()), doc_ids=([doc_ids], pa.list_(pa.int64())),
                    lens=([lens_b], pa.binary()), held=([held_b], pa.binary()),
                    n_known=([pack(n_known.astype("<u4"))], pa.binary()), base=([pack(base)], pa.binary()),
                    rest=([pack(rest)], pa.binary()), symbols=([pack(symbols.astype("<u4"))], pa.binary()),
                    symbol_keys=([pack(np.concatenate([[END, RARE], keys]))], pa.binary()),
                    symbol_lp=([pack(np.concatenate([[lp[end], lp_rare], lp[often]]))], pa.binary()),
                    symbol_n=([pack(np.concatenate([[c[end], 0], c[often]]).astype("<u8"))], pa.binary()))

    met = blocks.join(words, "block")
    return map_rows(met.select("block", "doc_ids", "lens", "held", "ids", "end_at", "parts"), run, PAIRS)


class Pairs:
    """A block's distinct (context, symbol) pairs, keys ascending: all, or those
    whose keys are from the first to below the second of ``within`` (None: no
    end)."""

    def __init__(self, lens: bytes, symbols: bytes, s_keys: bytes, s_lp: bytes, s_n: bytes,
                 min_context: int, within: tuple[np.uint64, np.uint64 | None] | None = None):
        self.lens = unpack(lens, "<u4").astype("i8")
        self.symbols = unpack(symbols, "<u4")
        self.s_keys, self.s_lp = unpack(s_keys, "<u8"), unpack(s_lp, "<f8")
        self.s_n = unpack(s_n, "<u8").astype(float)
        self.context = self.s_n >= min_context
        self.starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        # The symbol before each token; the end mark before a text's first.
        self.before = np.empty_like(self.symbols)
        self.before[1:] = self.symbols[:-1]
        self.before[self.starts] = 0
        first, second = halves(self.s_keys)
        of_token = second.take(self.symbols)
        of_token += first.take(self.before)
        stirred(of_token)
        use = self.context.take(self.before)
        if within:
            use &= of_token >= within[0]
            if within[1] is not None:
                use &= of_token < within[1]
        used = np.flatnonzero(use)
        self.keys, of_pair, place = distinct(of_token[used])
        self.u, self.x = self.before[used[of_pair]], self.symbols[used[of_pair]]
        self.pair = np.full(len(self.symbols), -1)   # the pair of each token
        self.pair[used] = place


SYMBOLS = ("lens", "symbols", "symbol_keys", "symbol_lp", "symbol_n")


def pair_entries(pairs: DataFrame, min_context: int, buckets: int, span: Span) -> DataFrame:
    edges = bounds(buckets)
    within = edges[span[0]], edges[span[1]] if span[1] < buckets else None

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, held, *packed in zip(*rows):
                p = Pairs(*packed, min_context, within)
                train = ~np.repeat(unpack(held, "u1").astype(bool), p.lens)
                counts = np.bincount(p.pair[(p.pair >= 0) & train], minlength=len(p.keys))
                yield dealt(block, p.keys, counts, p.s_keys[p.u], p.s_lp[p.x], buckets, span)
    return map_rows(pairs.select("block", "held", *SYMBOLS), run, DEALT)


def asked_words(pairs: DataFrame, min_context: int, buckets: int) -> DataFrame:
    """The words of a block that occur often enough to be contexts."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, keys, n in zip(*rows):
                keys = np.sort(unpack(keys, "<u8")[unpack(n, "<u8") >= min_context])
                yield dealt(block, keys, None, None, None, buckets)
    return map_rows(pairs.select("block", "symbol_keys", "symbol_n"), run, DEALT)


TRIPLES = ("block long, doc_ids array<long>, lens binary, held binary, n_known binary, base binary, "
           "score binary, tokens binary, per_doc binary, total binary, contexts binary, n_triples long")
#: A block's triples, a column for each range of them.
SLICES = [f"slice{i}" for i in range(RANGES["triples"])]
SLICE = ("keys", "counts", "ctx", "lp")
TRIPLES += "".join(f", {s} struct<{': binary, '.join(SLICE)}: binary>" for s in SLICES)


def triple_round(pairs: DataFrame, sums: DataFrame, kept: DataFrame, min_context: int) -> DataFrame:
    """Scores by contexts of up to one word, without the tokens that a longer
    context precedes; those tokens, their distinct triples, keys ascending and
    cut at the ranges' bounds, and the triples' distinct contexts. ``kept``: flags of ``asked_words``."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, doc_ids, held_b, known_b, base_b, rest, parts, flags, *packed in zip(*rows):
                p, total = Pairs(*packed, min_context), collected(parts)
                held, n_docs = unpack(held_b, "u1").astype(bool), len(p.lens)
                state, often = np.zeros(len(p.s_keys), bool), np.flatnonzero(p.context)
                state[often[np.argsort(p.s_keys[often])]] = flagged(flags)
                # Log-probability of each pair's symbol after its context.
                lp = np.where(state[p.u], log_state(total, p.s_n[p.u], PRIOR[1], p.s_lp[p.x]), p.s_lp[p.x])
                by_token = p.s_lp[p.symbols]
                paired = p.pair >= 0
                by_token[paired] = lp[p.pair[paired]]
                # Two words of context: the token before was itself paired, and
                # that pair is frequent; not across a text's start.
                doc = np.repeat(np.arange(n_docs), p.lens)
                earlier = np.full(len(p.symbols), -1)
                earlier[1:] = p.pair[:-1]
                earlier[p.starts] = -1
                long = (earlier >= 0) & paired & (p.before != 1)
                long[long] = total[earlier[long]] >= min_context
                # A pair's key is that of the context it makes, and pairs ascend by it.
                pair = earlier[long]
                keys, of_triple, tokens = distinct(mix(p.keys[pair], p.s_keys[p.symbols[long]]))
                used, _, c_at = distinct(pair[of_triple])
                parent = by_token[long][of_triple]
                counts = np.bincount(tokens[~held[doc[long]]], minlength=len(keys))
                score = np.bincount(doc[~long], by_token[~long], n_docs) + unpack(rest, "<f8")
                edges = np.append(np.searchsorted(keys, bounds(len(SLICES))), len(keys))
                cut = [[{"keys": pack_keys(keys[a:b]), "counts": pack(counts[a:b].astype("<u4")),
                         "ctx": pack(c_at[a:b].astype("<u4")), "lp": pack(parent[a:b].astype("<f4"))}]
                       for a, b in zip(edges, edges[1:])]
                yield batch_of(
                    block=([block], pa.int64()), doc_ids=([doc_ids], pa.list_(pa.int64())),
                    lens=([packed[0]], pa.binary()), held=([held_b], pa.binary()), n_known=([known_b], pa.binary()),
                    base=([base_b], pa.binary()), score=([pack(score)], pa.binary()),
                    tokens=([pack(tokens.astype("<u4"))], pa.binary()),
                    per_doc=([pack(np.bincount(doc[long], minlength=n_docs).astype("<u4"))], pa.binary()),
                    total=([pack(total[used].astype("<u8"))], pa.binary()),
                    contexts=([pack_keys(p.keys[used])], pa.binary()), n_triples=([len(keys)], pa.int64()),
                    **{s: (c, pa.struct([(f, pa.binary()) for f in SLICE])) for s, c in zip(SLICES, cut)})

    met = pairs.join(sums, "block", "left").join(kept, "block", "left")
    return map_rows(met.select("block", "doc_ids", "held", "n_known", "base", "rest", "parts", "flags", *SYMBOLS),
                    run, TRIPLES)


def triple_entries(triples: DataFrame, buckets: int, span: Span) -> DataFrame:
    """``buckets`` is a multiple of the ranges, so a span is a slice."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, contexts, keys, counts, ctx, lp in zip(*rows):
                yield dealt(block, unpack_keys(keys), unpack(counts, "<u4"),
                            unpack_keys(contexts)[unpack(ctx, "<u4")], unpack(lp, "<f4"), buckets)
    mine = SLICES[span[0] * len(SLICES) // buckets]
    return map_rows(triples.select("block", "contexts", *(f"{mine}.{f}" for f in SLICE)), run, DEALT)


def asked_pairs(triples: DataFrame, buckets: int) -> DataFrame:
    """The contexts of a block's triples."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, contexts in zip(*rows):
                yield dealt(block, unpack_keys(contexts), None, None, None, buckets)
    return map_rows(triples.select("block", "contexts"), run, DEALT)


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def score_round(triples: DataFrame, sums: DataFrame, kept: DataFrame, n: int) -> DataFrame:
    """The documents' scores. ``kept``: flags of ``asked_pairs``."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for doc_ids, lens, held, known, base, score, tokens, per_doc, total, parts, flags, *cut in zip(*rows):
                lp = np.concatenate([unpack(c["lp"], "<f4") for c in cut]).astype(float)
                ctx = np.concatenate([unpack(c["ctx"], "<u4") for c in cut])
                lp = np.where(flagged(flags)[ctx],
                              log_state(collected(parts), unpack(total, "<u8")[ctx], PRIOR[2], lp), lp)
                per_doc = unpack(per_doc, "<u4").astype("i8")
                more = np.bincount(np.repeat(np.arange(len(per_doc)), per_doc),
                                   lp[unpack(tokens, "<u4")], len(per_doc))
                yield batch_of(doc_id=(doc_ids, pa.int64()), held_out=(unpack(held, "u1").astype(bool), pa.bool_()),
                               n_tokens=(unpack(lens, "<u4").astype("i8"), pa.int64()),
                               n_known=(unpack(known, "<u4").astype("i8"), pa.int64()),
                               train_tokens=([n] * len(doc_ids), pa.int64()),
                               base_score=(unpack(base, "<f8") / math.log(10), pa.float64()),
                               score=((unpack(score, "<f8") + more) / math.log(10), pa.float64()))

    # The triples' keys and counts are not handed through the joins.
    scored = triples.withColumns({s: F.struct(f"{s}.ctx", f"{s}.lp") for s in SLICES})
    met = scored.join(sums, "block", "left").join(kept, "block", "left")
    return map_rows(met.select("doc_ids", "lens", "held", "n_known", "base", "score", "tokens", "per_doc",
                               "total", "parts", "flags", *SLICES), run, SCORES)


def _whole_blocks(spark) -> None:
    """From here on a row is a block: hand Python one at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")


def score_documents(docs: DataFrame, held: Column, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probabilities); documents for which ``held`` holds are not learnt."""
    spark = docs.sparkSession
    with batch_rows(spark, ARROW_ROWS), setting(spark, DROP_SHUFFLES, "true"), setting(spark, *TASK_BYTES):
        return _scores(docs, held, id_col, text_col)   # written, each step by its own counts of rows


def _scores(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    blocks_at, pairs_at, triples_at, scores_at = (
        scratch_path(spark, f"llm-{name}") for name in ("blocks", "pairs", "triples", "scores"))
    by_turn(blocks_of(docs, held, id_col, text_col), blocks_at)
    blocks = of_turns(spark, blocks_at, BLOCKS)
    size = blocks.agg(F.sum("n_train").alias("n"), F.sum("n_keys").alias("k"), F.sum("n_tokens").alias("t"),
                      F.collect_set("turn").alias("turns")).first()
    n, turns = size["n"] or 0, sorted(size["turns"])
    if not turns:
        return spark.createDataFrame([], SCORES)

    def used(turn: int, *folders: str) -> None:
        for folder in folders:
            delete_path(spark, f"{folder}/turn={turn}")

    def used_sums(turn: int, folder: str, name: str) -> None:
        used(turn, *(f"{folder}/span={i}" for i in range(RANGES[name])))

    def answers(asked: DataFrame, kept: DataFrame, buckets: int) -> DataFrame:
        """``kept_flags`` of all blocks, written: bits, so not taken in turns."""
        path = scratch_path(spark, "llm-flags")
        by_turn(kept_flags(asked, kept, buckets), path)
        return of_turns(spark, path, FLAGS)

    def vocabulary(keys: np.ndarray, c: np.ndarray, *_) -> tuple[np.ndarray, ...]:
        rare = (c > 0) & (c < MIN_SYMBOL) & (keys != END)
        return np.zeros(1, "u8"), np.array([(c > 0).sum()], float), np.array([(c[rare] + 1).sum()])

    _whole_blocks(spark)
    buckets = size["k"] // ENTRIES + 8
    sums, known, sums_at = totals(spark, lambda span: word_entries(blocks, buckets, span), buckets,
                                  "words", vocabulary, MIN_SYMBOL)
    v = known.agg(F.sum("a").alias("v"), F.sum("b").alias("rare")).first()
    _whole_blocks(spark)
    for t in turns:
        symbols = symbol_round(in_turn(blocks, t), parts_of(sums, t), n, int(v["v"] or 0),
                               (v["rare"] or 0.0) + 1.0, MIN_SYMBOL)
        symbols.write.parquet(f"{pairs_at}/turn={t}")
        used(t, blocks_at)
        used_sums(t, sums_at, "words")

    pairs = of_turns(spark, pairs_at, PAIRS)
    # A block's distinct pairs are about half of its tokens.
    of_pairs = size["t"] // (2 * ENTRIES) + 8
    sums, gains, sums_at = totals(spark, lambda span: pair_entries(pairs, MIN_CONTEXT, of_pairs, span), of_pairs,
                                  "pairs", leave_one_out(PRIOR[1]))
    flags = answers(asked_words(pairs, MIN_CONTEXT, of_pairs), kept_contexts(gains, PRIOR[1]), of_pairs)
    _whole_blocks(spark)
    for t in turns:
        mine = in_turn(pairs, t)
        triple_round(mine, parts_of(sums, t), in_turn(flags, t), MIN_CONTEXT).write.parquet(f"{triples_at}/turn={t}")
        used(t, pairs_at)
        used_sums(t, sums_at, "pairs")

    triples = of_turns(spark, triples_at, TRIPLES)
    of_triples = (triples.agg(F.sum("n_triples").alias("n")).first()["n"] or 0) // ENTRIES + 8
    of_triples = -(-of_triples // len(SLICES)) * len(SLICES)
    sums, gains, sums_at = totals(spark, lambda span: triple_entries(triples, of_triples, span), of_triples,
                                  "triples", leave_one_out(PRIOR[2]))
    flags = answers(asked_pairs(triples, of_triples), kept_contexts(gains, PRIOR[2]), of_triples)
    _whole_blocks(spark)
    for t in turns:
        mine = in_turn(triples, t)
        score_round(mine, parts_of(sums, t), in_turn(flags, t), n).write.parquet(f"{scores_at}/turn={t}")
        used(t, triples_at)
        used_sums(t, sums_at, "triples")
    return of_turns(spark, scores_at, SCORES).drop("turn")
