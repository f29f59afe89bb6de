import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterline.llm import bpe, packing
from meterline.llm.queries import op4_bpe_round_trip, op8_harmonic_packing
from tests.conftest import SF001
from tests.llm.helpers import awkward, empty, rows, stored

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LETTERS = [*"ab'sre lldtmvX1 92.,!  \n\n\t\r\x0b\x0c\x1c\x1d\x85\xa0 　éàßΣςİªº日本🙂́",
           "<|endoftext|>", "<|startoftext|>", " the", "​", "﻿", "'ll", ".,", "...", "a.", "é,"]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


def test_forced_boundaries_equal_the_library():
    mine, library = bpe.ForcedBoundaryBPE(BYTE), Tokenizer.from_file(BYTE)
    for t in random_texts(6000, 1) + ["x" * 20_000, "é " * 3000]:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(mine.encode(t)) == want, repr(t)
        assert mine.decode(mine.encode(t)) == library.decode(want, skip_special_tokens=False)


def test_forced_pairs_are_inside_no_token():
    mine = bpe.ForcedBoundaryBPE(BYTE)
    pairs = {(a, b) for t in mine.bytes_of.values() for a, b in zip(t, t[1:])}
    pairs -= {(a, b) for c in mine.added for a, b in zip(c.encode(), c.encode()[1:])}
    letters = bpe.byte_letters()
    assert {letters[a] + letters[b] for a, b in pairs} <= mine.joined
    assert mine.forced(ord("e"), ord(" ")) and not mine.forced(ord("t"), ord("h"))


def test_word_ids_equal_the_library():
    mine, library = packing.WordIds(WORD), Tokenizer.from_file(WORD)
    for t in random_texts(6000, 2):
        assert ids(mine(t)) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    mine, other = packing.WordIds(WORD), bpe.ForcedBoundaryBPE(BYTE)
    lib, lib2 = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    t = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100))
    for _ in range(2):
        assert ids(mine(t)) == lib.encode(t, add_special_tokens=False).ids
        assert ids(other.encode(t)) == lib2.encode(t, add_special_tokens=False).ids
    assert len(mine) <= 10 and len(mine.plain) <= 10 and len(other.chunks) <= 10


def test_closing_marks_are_encoded_once_for_all_words():
    mine, library, asked = packing.WordIds(WORD), Tokenizer.from_file(WORD), []

    class Counted:
        model = mine.library.model

        def encode(self, text, **kw):
            asked.append(text)
            return library.encode(text, **kw)

    mine.library = Counted()
    t = "thereon$$$ Whereat$$$ whereat!? Thereon Étude.'\" x's"
    assert ids(mine(t)) == library.encode(t, add_special_tokens=False).ids
    assert asked == ["$$$", "!?", ".'\"", "x's"]


@pytest.mark.parametrize("where", [None, "odd"])
def test_round_trip_query(spark, where):
    at = SF001 if where is None else stored(spark, "bpe", documents=awkward(spark))
    library = Tokenizer.from_file(BYTE)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    want = []
    for i, t in texts:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in op4_bpe_round_trip(spark, at).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_encode_then_decode_operators(spark):
    docs = awkward(spark)
    back = bpe.decode_documents(bpe.encode_documents(docs, BYTE), BYTE).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=repr) == sorted(
        ((r[0], r[1] or "") for r in rows()), key=repr)
    assert bpe.encode_documents(empty(spark), BYTE).count() == 0


def test_cuts_cover_a_document_in_whole_classes():
    for n in [*range(1, 9000, 7), 4095, 4096, 4097, 2049, 2048, 100_000]:
        at = 0
        for start, length, j in packing.cuts(n, 4096, 0.02):
            assert start == at and 0 < length <= 4096 // j and length > 4096 // (j + 1)
            assert length >= 0.98 * (4096 // j) - 1
            at += length
        assert at == n


def test_best_fit_never_overflows():
    rnd = random.Random(5)
    lengths = [rnd.randint(1, 4096) for _ in range(3000)]
    load = {}
    for n, b in zip(lengths, packing.best_fit(lengths, 4096)):
        load[b] = load.get(b, 0) + n
    assert max(load.values()) <= 4096 and sorted(load) == list(range(len(load)))


@pytest.mark.parametrize("where", [None, "odd"])
def test_packing_query(spark, where):
    at = SF001 if where is None else stored(spark, "pack", documents=awkward(spark))
    library = Tokenizer.from_file(WORD)
    out = op8_harmonic_packing(spark, at).collect()
    bins, pieces = {}, {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for b in bins.values():
        at_ = 0
        for offset, length in sorted(b):
            assert offset == at_
            at_ += length
        assert at_ <= 4096
    want = {}
    for r in spark.read.parquet(f"{at}/documents.parquet").collect():
        e = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault((r["doc_id"], len(e)), []).extend(
            (s, n, zlib.crc32(e[s:s + n].tobytes())) for s, n, _ in packing.cuts(len(e), 4096, 0.02))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    if where is None:
        total = sum(n for b in bins.values() for _, n in b)
        assert 1 - total / (4096 * len(bins)) < 0.03


def test_packing_an_empty_table(spark):
    assert op8_harmonic_packing(spark, stored(spark, "pack0", documents=empty(spark))).count() == 0
