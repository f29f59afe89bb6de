"""Chat formatting as prefix trees.

Conversations that begin with the same turns share those turns' tokens. Every
distinct prefix is one node of a tree; a tree is emitted depth first, each node
once, with

* position ids: a node's first token has the position it has in any of its
  conversations (the tokens of its ancestors), whatever its place in the tree;
* attention: the intervals of the tree's tokens that hold its ancestors. A
  token sees those and the tokens before it in its own node.

Template: ``[INST]`` role ``[/INST]`` text ``</s>``. In roles and texts a
backslash is doubled and a control string gets a backslash after its first
character, so no control string is left inside and dropping each backslash
restores the text. The loss mask covers the text of assistant turns.

Depth-first order without a task that holds a tree: conversations are sorted by
their path (a range shuffle), a node belongs to the first conversation that
passes through it, and (that conversation, depth) is the depth-first order.
Token offsets are running sums within sorted partitions plus the totals of the
partitions before. Turns stream through their tasks in order, so a very long
conversation is never held whole. Its path holds only the nodes at which other
conversations part from it, 16 bytes each, not its turns.

Defined cases: NULL texts and roles are empty. Turns go by (turn, role, text),
NULL turns first; repeated rows are turns of their own; very long texts are one
turn like any other. Rows without a conv_id form one conversation. An empty
table gives empty results. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import batch_of, map_rows, text_of, written

#: Control strings of the template and others a text must not bring in.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
ASSISTANT = "assistant"


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(turn: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    m = re.fullmatch(r"\[INST\](.*?)\[/INST\](.*)</s>", turn, flags=re.S)
    return unescape(m[1]), unescape(m[2])


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True   # a text's own strings stay text
    return t


TURNS = "conv_id long, depth int, node binary, parent binary, root binary, role string, text string"


def _turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its node, the hash of all turns up to it, and the node before."""
    rows = (conversations.select("conv_id", "turn", text_of("role").alias("role"),
                                 text_of("text").alias("text"))
                         .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        key, node, root, depth = object(), b"", b"", 0
        for convs, _, roles, texts in batches:
            depths, nodes, parents, roots = [], [], [], []
            for conv, role, text in zip(convs, roles, texts):
                if conv != key:
                    key, node, depth = conv, b"", 0
                a = role.encode()
                parents.append(node)
                node = hashlib.blake2b(node + len(a).to_bytes(8, "little") + a + text.encode(),
                                       digest_size=16).digest()
                root = node if depth == 0 else root
                depths.append(depth)
                nodes.append(node)
                roots.append(root)
                depth += 1
            yield batch_of(conv_id=(convs, pa.int64()), depth=(depths, pa.int32()), node=(nodes, pa.binary()),
                           parent=(parents, pa.binary()), root=(roots, pa.binary()),
                           role=(roles, pa.string()), text=(texts, pa.string()))
    return map_rows(rows, run, TURNS)


def _paths(turns: DataFrame) -> DataFrame:
    """conv_id, path of every conversation: its root and then, of its nodes, only
    those with siblings. Conversations that share a prefix share the path up to
    it, and part at the first node that differs, so the order of paths keeps every
    subtree together."""
    steps = turns.select("conv_id", "depth", "node", "parent")
    # Stored, so that the join at a turn that very many conversations share can be split.
    forks = written(steps.filter("depth > 0").groupBy("parent")
                         .agg(F.min("node").alias("least"), F.max("node").alias("most"))
                         .filter("least <> most").select("parent"), "forks")
    taken = (steps.filter("depth > 0").join(forks, "parent").select("conv_id", "depth", "node")
                  .unionByName(steps.filter("depth = 0").select("conv_id", "depth", "node")))
    return taken.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: x["node"]).alias("path"))


@dataclass
class Forest:
    """``turns``: conv_id, depth, node, root. ``nodes``: node, root, depth,
    start (of its first token, in its tree), n_tokens, position (of its first
    token), loss_from, loss_to (tokens under the loss mask, within the node),
    ids (little-endian unsigned 32-bit), sees (array of [from, to) intervals
    of the tree's tokens that hold its ancestors)."""
    turns: DataFrame
    nodes: DataFrame


NODES = ("node binary, root binary, depth int, first long, n_tokens int, loss_from int, loss_to int, "
         "ids binary, before long, part int")


def _emitted(owners: DataFrame, path: str) -> DataFrame:
    """Nodes in depth-first order, formatted and tokenised; ``before`` counts
    the tokens ahead of a node within its partition."""
    ordered = owners.repartitionByRange("first", "depth").sortWithinPartitions("first", "depth")

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        encode, part, total = tokenizer(path).encode_batch_fast, TaskContext.get().partitionId(), 0
        for nodes, roots, depths, firsts, roles, texts in batches:
            heads = encode([f"[INST]{escape(r)}[/INST]" for r in roles], add_special_tokens=False)
            bodies = encode([escape(t) for t in texts], add_special_tokens=False)
            end = encode(["</s>"], add_special_tokens=False)[0].ids
            ids, n, a, b, before = [], [], [], [], []
            for role, head, body in zip(roles, heads, bodies):
                h, t = head.ids, body.ids
                ids.append(np.array([*h, *t, *end], "<u4").tobytes())
                n.append(len(h) + len(t) + len(end))
                a.append(len(h))
                b.append(len(h) + (len(t) if role == ASSISTANT else 0))
                before.append(total)
                total += n[-1]
            yield batch_of(node=(nodes, pa.binary()), root=(roots, pa.binary()), depth=(depths, pa.int32()),
                           first=(firsts, pa.int64()), n_tokens=(n, pa.int32()), loss_from=(a, pa.int32()),
                           loss_to=(b, pa.int32()), ids=(ids, pa.binary()), before=(before, pa.int64()),
                           part=([part] * len(n), pa.int32()))
    return map_rows(ordered.select("node", "root", "depth", "first", "role", "text"), run, NODES)


def _visibility(members: DataFrame) -> DataFrame:
    """node, position, sees: walks each conversation's nodes in order and
    reports those it owns."""
    rows = (members.repartition("of").sortWithinPartitions("of", "depth")
                   .select("of", "node", "at", "n_tokens", "own"))

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        conv, position, seen = None, 0, []
        for of, nodes, starts, lengths, owned in batches:
            found = []
            for c, node, start, n, own in zip(of, nodes, starts, lengths, owned):
                if c != conv:
                    conv, position, seen = c, 0, []
                if own:
                    found.append((node, position, [{"from": x, "to": y} for x, y in seen]))
                position += n
                if seen and seen[-1][1] == start:
                    seen[-1] = (seen[-1][0], start + n)
                else:
                    seen.append((start, start + n))
            cols = list(zip(*found)) or [(), (), ()]
            yield batch_of(node=(cols[0], pa.binary()), position=(cols[1], pa.int64()),
                           sees=(cols[2], pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))))
    return map_rows(rows, run, "node binary, position long, sees array<struct<from:long,to:long>>")


def prefix_forest(conversations: DataFrame, tokenizer_path: str) -> Forest:
    """Format, merge and tokenise all conversations."""
    turns = written(_turns(conversations), "turns")
    # Conversations in the order of their paths: the id rises with the order.
    leaves = written(_paths(turns)
                          .repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
                          .select("conv_id", F.monotonically_increasing_id().alias("of")), "leaves")
    leaves = leaves.withColumnRenamed("conv_id", "c")
    walked = written(turns.join(leaves, turns["conv_id"].eqNullSafe(leaves["c"]))
                          .select("of", "depth", "node"), "walked")
    first = walked.groupBy("node").agg(F.min("of").alias("first"))
    owners = (first.join(leaves, first["first"] == leaves["of"])
                   .join(turns, (first["node"] == turns["node"]) & F.col("conv_id").eqNullSafe(F.col("c")))
                   .select(turns["node"], "root", "depth", "first", "role", "text"))
    emitted = written(_emitted(owners, tokenizer_path), "emitted")
    # One number per partition.
    ends = emitted.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n")) \
                  .orderBy("part").collect()
    total, offsets = 0, []
    for r in ends:
        offsets.append((r["part"], total))
        total += r["n"]
    offsets = conversations.sparkSession.createDataFrame(offsets, "part int, ahead long")
    placed = emitted.join(offsets, "part").withColumn("global", F.col("before") + F.col("ahead"))
    starts = placed.filter("depth = 0").select("root", F.col("global").alias("tree"))
    narrow = (placed.select("node", "root", "first", "n_tokens", "global").join(starts, "root")
                    .withColumn("start", F.col("global") - F.col("tree")))
    narrow = written(narrow.select("node", "first", "n_tokens", "start"), "starts")
    members = walked.join(narrow, "node").select(
        "of", "depth", "node", F.col("start").alias("at"), "n_tokens",
        (F.col("of") == F.col("first")).alias("own"))
    nodes = (emitted.drop("first", "before", "part")
                    .join(narrow.select("node", "start"), "node").join(_visibility(members), "node"))
    return Forest(turns.select("conv_id", "depth", "node", "root"), nodes)


def read_back(forest: Forest, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_tokens of every conversation, from the forest's tokens: ids are decoded,
    turns parsed and unescaped; loss is what decodes under the mask."""
    nodes = forest.nodes.select("node", "ids", "loss_from", "loss_to", "position",
                                F.aggregate("sees", F.lit(0).cast("long"),
                                            lambda n, s: n + s["to"] - s["from"]).alias("seen"))
    rows = (forest.turns.select("conv_id", "depth", "node").join(nodes, "node")
                  .repartition("conv_id").sortWithinPartitions("conv_id", "depth")
                  .select("conv_id", "ids", "loss_from", "loss_to", "position", "seen"))

    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        decode = functools.partial(tokenizer(tokenizer_path).decode, skip_special_tokens=False)
        key, now = object(), None

        def done() -> tuple:
            return (key, now["n"], now["turns"].hexdigest(), now["loss_n"], now["loss"].hexdigest(),
                    now["chars"], now["tokens"])

        def out(found: list[tuple]) -> pa.RecordBatch:
            c = list(zip(*found)) or [()] * 7
            return batch_of(conv_id=(c[0], pa.int64()), n_turns=(c[1], pa.int64()),
                            turns_sha256=(c[2], pa.string()), loss_chars=(c[3], pa.int64()),
                            loss_sha256=(c[4], pa.string()), formatted_chars=(c[5], pa.int64()),
                            n_tokens=(c[6], pa.int64()))

        for convs, ids, froms, tos, positions, seen in batches:
            found = []
            for conv, b, lo, hi, position, n_seen in zip(convs, ids, froms, tos, positions, seen):
                if now is None or conv != key:
                    if now is not None:
                        found.append(done())
                    key = conv
                    now = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_n": 0,
                           "chars": 0, "tokens": 0}
                if not position == n_seen == now["tokens"]:
                    raise ValueError(f"conversation {conv}: positions and attention disagree")
                tokens = np.frombuffer(b, "<u4").tolist()
                turn = decode(tokens)
                role, text = parse(turn)
                now["turns"].update(f"{role}\n{text}\n".encode())
                masked = unescape(decode(tokens[lo:hi]))
                now["loss"].update(masked.encode())
                now["loss_n"] += len(masked)
                now["n"] += 1
                now["chars"] += len(turn)
                now["tokens"] += len(tokens)
            yield out(found)
        if now is not None:
            yield out([done()])
    return map_rows(rows, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                               "loss_sha256 string, formatted_chars long, n_tokens long")
