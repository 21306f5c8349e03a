"""Encoding of a corpus by a public byte-level BPE vocabulary, by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that can be the last of its encoding: a token that ends
there, and that may stand after the last token of the shorter prefix. An automaton over the vocabulary lists the tokens
that end at each position; a test of the pair decides; the token is stored for the prefix, and following the stored
tokens backwards from the end gives the ids. The work is linear in the text even for pieces of a megabyte.

A pair may stand together if, while both are being built from bytes, no merge across their border would have come first.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataforge.llm.textbuf import worker_value

#: Default place of the vocabulary file.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the public pattern that splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces kept with their ids; longer ones than this many characters are encoded anew each time.
KEPT_PIECES, KEPT_LENGTH, KEPT_PAIRS = 400_000, 48, 1_000_000
NEVER = 1 << 30
#: Ids in one batch of results, and characters of a text whose pieces may be listed at once.
IDS_PER_BATCH, LISTED_CHARS = 1_000_000, 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The character each byte is written as: printable Latin-1 bytes as themselves, the rest in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts without special tokens; their strings in a text are ordinary text."""

    def __init__(self, vocabulary: bytes) -> None:
        import ahocorasick
        import regex

        model = json.loads(vocabulary)["model"]
        alphabet = byte_alphabet()
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}  # the merge's place by its two parts
        self.parts: dict[int, tuple[int, int, int]] = {}  # left, right and the merge's place by the whole
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = ids[left], ids[right]
            self.rank[pair] = place
            self.parts[ids[left + right]] = (*pair, place)
        self.length: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in ids.items():
            if i in self.parts or len(text) == 1:  # the others are special and can't come from merges
                self.length[i] = len(text)
                self.automaton.add_word("".join(chr(alphabet[c]) for c in text), i)
        self.automaton.make_automaton()
        self.pattern = regex.compile(PATTERN)
        self.right_edges: dict[int, list[tuple[int, int]]] = {}
        self.left_edges: dict[int, list[tuple[int, int]]] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def _edges(self, token: int, side: int, kept: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The tokens at one edge of a token while it is built, from the byte upwards, each with the place of the merge that consumes it."""
        if token not in kept:
            chain_, t, until = [], token, NEVER
            while t in self.parts:
                chain_.append((t, until))
                until = self.parts[t][2]
                t = self.parts[t][side]
            chain_.append((t, until))
            kept[token] = chain_[::-1]
        return kept[token]

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._may_follow(a, b)
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        left, right = self._edges(a, 1, self.right_edges), self._edges(b, 0, self.left_edges)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.rank.get((x, y))
            # Of equal merges the leftmost is made first: before the one in b, after the one in a.
            if across is not None and across < x_until and across <= y_until:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8").decode("latin-1")
        size = len(data)
        last: list[int] = [-1] * (size + 1)
        length, may_follow = self.length, self.may_follow
        for end, token in self.automaton.iter(data):
            end += 1
            if last[end] < 0:
                start = end - length[token]
                if start == 0 or (last[start] >= 0 and may_follow(last[start], token)):
                    last[end] = token
        out = []
        while size:
            token = last[size]
            out.append(token)
            size -= length[token]
        return tuple(out[::-1])

    def encode_into(self, text: str, ids: array) -> None:
        """Appends the text's ids; pieces of a very long text are made one by one, not all at once."""
        pieces = self.pattern.findall(text) if len(text) <= LISTED_CHARS else (m.group() for m in self.pattern.finditer(text))
        ids.extend(chain.from_iterable(map(self.pieces.__getitem__, pieces)))

    def encode(self, text: str) -> list[int]:
        ids = array("i")
        self.encode_into(text, ids)
        return ids.tolist()


class _Pieces(dict):
    """Ids of pieces seen lately."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encoder.encode_piece(piece)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def encode_corpus(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text): whole texts, in place, without a shuffle.

    Empty and null texts give an empty list. The vocabulary (1.5 MB) is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(path, "rb") as f:
        data = f.read()
    vocabulary, digest = spark.sparkContext.broadcast(data), f"{len(data)}-{zlib.crc32(data)}"
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_value("encoder", digest, lambda: Encoder(vocabulary.value))

        def flush(keys: list, flat: array, ends: list) -> pa.RecordBatch:
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids], schema=schema)

        for batch in batches:
            keys, flat, ends = [], array("i"), [0]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                encoder.encode_into(text.as_py() or "", flat)
                ends.append(len(flat))
                keys.append(key)
                if len(flat) >= IDS_PER_BATCH:
                    yield flush(keys, flat, ends)
                    keys, flat, ends = [], array("i"), [0]
            if keys:
                yield flush(keys, flat, ends)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")
