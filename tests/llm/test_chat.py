import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterline.llm import chat
from meterline.llm.queries import op1_chat_format
from tests.conftest import SF001
from tests.llm.helpers import stored

SCHEMA = "conv_id long, turn long, role string, text string, node string, path string, depth int"
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def odd_rows():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"same turn {t}" if t < 2 else f"own {c} {t}")
            for c in range(30) for t in range(c % 6 + 1)]
    rows += [(100, 0, None, None), (100, 1, "assistant", None), (101, None, "system", "s"),
             (101, 0, "user", ""), (101, 0, "user", ""), (101, 0, "assistant", "a\\b [/INST] </s>"),
             (None, 0, "user", "nobody"), (None, 1, "assistant", "[INST]"), (102, 0, "x" * 50, "y" * 40_000)]
    rows += [(103, t, "assistant", f"t{t}") for t in range(400)]
    # One that ends inside the long one, one that is equal to it, two that part from it.
    rows += [(104, t, "assistant", f"t{t}") for t in range(150)] + [(105, t, "assistant", f"t{t}") for t in range(400)]
    rows += [(c, t, "assistant", f"t{t}" if t < 90 else f"{c} t{t}") for c in (106, 107) for t in range(95)]
    random.Random(1).shuffle(rows)
    return [(*r, "n", "p", 1) for r in rows]


def want(rows):
    talks = {}
    for r in rows:
        talks.setdefault(r[0], []).append(r)
    out = {}
    for c, rs in talks.items():
        rs = sorted(rs, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or ""), (r[3] or "")))
        turns = [(r[2] or "", r[3] or "") for r in rs]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in df.collect()}


CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@pytest.mark.parametrize("where", [None, "odd", "none"])
def test_read_back_equals_the_rows(spark, where):
    if where is None:
        at = SF001
    else:
        df = spark.createDataFrame(odd_rows() if where == "odd" else [], SCHEMA)
        at = stored(spark, "chat", conversations=df)
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"])
            for r in spark.read.parquet(f"{at}/conversations.parquet").collect()]
    assert got(op1_chat_format(spark, at)) == want(rows + CONTROL)


def test_escaping_is_reversible_and_leaves_no_control_string():
    rnd = random.Random(2)
    bits = ["\\", "[", "]", "<", "/", "s>", "INST", "a", "\n", *chat.CONTROLS]
    for _ in range(5000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 10)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)
        assert chat.parse(f"[INST]{e}[/INST]{e}</s>") == (t, t)


def test_trees_emit_shared_tokens_once_depth_first(spark):
    forest = chat.prefix_forest(spark.createDataFrame(odd_rows(), SCHEMA), BYTE)
    nodes = {bytes(r["node"]): r for r in forest.nodes.collect()}
    turns = {}
    for r in forest.turns.collect():
        turns.setdefault(r["conv_id"], []).append((r["depth"], bytes(r["node"])))
    assert len(nodes) == len({n for t in turns.values() for _, n in t})
    assert len(nodes) < sum(map(len, turns.values()))
    trees = {}
    for r in nodes.values():
        trees.setdefault(bytes(r["root"]), []).append((r["start"], r["n_tokens"]))
        assert len(r["ids"]) == 4 * r["n_tokens"]
    for spans in trees.values():   # gapless, no token twice
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
    for path in turns.values():
        seen, last = set(), None
        for _, n in sorted(path):
            r = nodes[n]
            assert r["position"] == len(seen)
            assert {i for s in r["sees"] for i in range(s["from"], s["to"])} == seen
            assert last is None or r["start"] > last   # a child comes after its parent
            last = r["start"]
            seen |= set(range(r["start"], r["start"] + r["n_tokens"]))
        # A subtree is contiguous: depth-first.
    for n, r in nodes.items():
        below = {m for t in turns.values() for d, m in t if n in [x for _, x in sorted(t)[:d + 1]]}
        spans = sorted((nodes[m]["start"], nodes[m]["n_tokens"]) for m in below)
        assert spans[-1][0] + spans[-1][1] - spans[0][0] == sum(k for _, k in spans)


def test_a_path_holds_forks_not_turns(spark):
    """A third of all rows in one conversation: its path is as long as the forks on it."""
    turns = chat._turns(spark.createDataFrame(odd_rows(), SCHEMA))
    paths = {r["conv_id"]: r["path"] for r in chat._paths(turns).collect()}
    assert {c: len(paths[c]) for c in (102, 103, 104, 105, 106, 107)} == {102: 1, 103: 2, 104: 2, 105: 2, 106: 2, 107: 2}
    assert paths[103] == paths[104] == paths[105] != paths[106] != paths[107]


def test_tokens_decode_to_the_template():
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    text = "[INST]user[/INST]" + chat.escape("<|endoftext|> x") + "</s>"
    assert t.decode(t.encode(text, add_special_tokens=False).ids, skip_special_tokens=False) == text
