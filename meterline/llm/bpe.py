"""Byte-pair encoding by forced-boundary splitting.

A pair of bytes that occurs inside no vocabulary token can never be merged
across, so every such pair in a text marks a certain cut: the pieces on either
side encode independently and their ids are concatenated. Cuts are used at two
levels:

* in the text: before a space or line feed that follows a visible character
  (no token holds such a pair, and the vocabulary's own word pattern always
  breaks there too), which leaves short chunks that repeat all over a corpus;
* inside the words of a chunk: wherever two neighbouring bytes are a forced
  pair. The fragments go through the vocabulary's merges.

Chunks and fragments already encoded are remembered in bounded tables, so a
worker's memory does not follow its input.

Decoding looks up each id's bytes, concatenates them and reads the result as
UTF-8. Defined cases: NULL text counts as empty; an empty text has no ids; the
strings of added tokens (such as ``<|endoftext|>``) encode to their ids. Every row,
repeated ones too, gives one row; an empty table gives an empty result; a very
long text is encoded whole, in its worker's memory. Only the id and the text are
read; other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterline.llm.common import batch_of, map_rows

#: Entries a worker remembers before it starts its table anew.
REMEMBERED = 400_000


def byte_letters() -> list[str]:
    """Byte-level vocabularies write each byte as one letter: printable Latin-1
    bytes as themselves, the others, in order, as the letters from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class ForcedBoundaryBPE:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.letter_of = dict(enumerate(byte_letters()))
        self.bytes_of: dict[int, bytes] = {}
        self.joined: set[str] = set()   # letter pairs inside some token
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
            self.joined.update(a + b for a, b in zip(token, token[1:]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
        self.specials = re.compile("(" + "|".join(
            re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") \
            if self.added else None
        self.chunk = self._chunk_pattern()
        self.chunks: dict[str, bytes] = {}
        self.fragments: dict[str, tuple[int, ...]] = {}

    def forced(self, left: int, right: int) -> bool:
        """Whether no token holds these two bytes in a row."""
        letters = byte_letters()
        return letters[left] + letters[right] not in self.joined

    def _chunk_pattern(self) -> re.Pattern:
        """Chunks end before a space or line feed that follows a visible
        character, where that byte pair is forced, and at the text's end."""
        blank = set(b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
        loose = {a for a in range(256) if a not in blank
                 if not all(self.forced(a, b) for b in b" \n")}
        # Characters after which no chunk ends: their last byte is loose.
        # Those beyond the basic plane are taken along for a short pattern.
        glue = "".join(re.escape(chr(c)) for c in range(0x21, 0xD800)
                       if chr(c).encode()[-1] in loose) + "\ue000-\uffff\U00010000-\U0010ffff"
        # Other white space never starts a chunk: what follows stays on.
        rest = rf"\s*\S+(?:(?:(?<=[{glue}])\s+|[^\S \n]\s*)(?:\S+|\Z))*|\s+"
        # A Latin word also ends before a comma or full stop where that pair
        # is forced: the word pattern never joins a letter and a mark.
        letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
        ends = "".join(c for c in letters if all(self.forced(c.encode()[-1], m) for m in b".,"))
        if ends:
            rest = rf"[ \n]?[{''.join(letters)}]*[{ends}](?=[.,])|" + rest
        return re.compile(rest)

    def _fragment(self, fragment: str) -> tuple[int, ...]:
        ids = self.fragments.get(fragment)
        if ids is None:
            ids = tuple(t.id for t in self.library.model.tokenize(fragment))
            if len(self.fragments) >= REMEMBERED:
                self.fragments.clear()
            self.fragments[fragment] = ids
        return ids

    def _encode_chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        bare = chunk[1:] if chunk[0] == " " else chunk
        if bare.isalpha() and max(bare) < "\u0250":   # one Latin word
            words = [chunk.encode().decode("latin-1").translate(self.letter_of)]
        else:
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        for word in words:
            start = 0
            for i in range(1, len(word)):
                if word[i - 1:i + 1] not in self.joined:
                    ids += self._fragment(word[start:i])
                    start = i
            ids += self._fragment(word[start:])
        return np.array(ids, "<u4").tobytes()

    def _segment(self, text: str) -> bytes:
        pieces = self.chunk.findall(text)
        known = self.chunks
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        out = []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = self._encode_chunk(piece)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(piece) < 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or not any(c in text for c in self.added):
            return self._segment(text)
        return b"".join(
            np.array([self.added[part]], "<u4").tobytes() if part in self.added
            else self._segment(part) for part in self.specials.split(text) if part)

    def decode(self, ids: bytes) -> str:
        """The text of ids in that form."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ForcedBoundaryBPE:
    """One encoder per worker and vocabulary."""
    return ForcedBoundaryBPE(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """id, ids (binary, little-endian unsigned 32-bit) of every whole text."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for keys, texts in batches:
            yield batch_of(doc_id=(keys, pa.int64()),
                           ids=([bpe.encode(t or "") for t in texts], pa.binary()))
    return map_rows(docs.select(id_col, text_col), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of encoded documents."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for keys, ids in batches:
            yield batch_of(doc_id=(keys, pa.int64()),
                           text=([bpe.decode(i) for i in ids], pa.string()))
    return map_rows(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Digests of each text's ids and of the text decoded from them. Encoding
    and decoding run in one pass, so the ids themselves are not moved."""
    def run(batches: Iterator[list[list]]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for keys, texts in batches:
            n, a, b = [], [], []
            for t in texts:
                ids = bpe.encode(t or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield batch_of(doc_id=(keys, pa.int64()), n_tokens=(n, pa.int64()),
                           ids_sha256=(a, pa.string()), decoded_sha256=(b, pa.string()))
    return map_rows(docs.select(id_col, text_col), run,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
