"""Texts of Arrow batches as numpy blocks of bounded size, and fingerprints of their stretches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

#: Odd, so that it has an inverse modulo 2**64 and a stretch's fingerprint doesn't depend on where it lies.
BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, i = 0..n, modulo 2**64; kept and grown as needed."""
    if not _powers or len(_powers["up"]) <= n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Fingerprints:
    """64-bit fingerprints of any stretch of a block of symbols, each O(1). ``second``: others, independent of the first."""

    def __init__(self, symbols: np.ndarray, second: bool = False) -> None:
        n = len(symbols)
        up, self.down = powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        wide = symbols.astype(np.uint64)
        np.cumsum((scramble(wide + np.uint64(0x1F83D9AB)) if second else wide * _MIX + np.uint64(0x2545F491)) * up[:n], out=self.sums[1:])

    def of_all(self, length: int) -> np.ndarray:
        """Of every stretch of this length."""
        return scramble((self.sums[length:] - self.sums[:-length]) * self.down[: len(self.sums) - length])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.down[start])


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points one after another, and where each text begins (one entry more than texts)."""
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return joined, starts


def cut_at_characters(text: str, chars: int, overlap: int) -> Iterator[tuple[int, str]]:
    """Offset and text of pieces of ``chars`` characters, each with the next ``overlap`` ones: every stretch of overlap + 1
    characters begins in exactly one piece's own part."""
    for at in range(0, len(text) - overlap, chars):
        yield at, text[at : at + chars + overlap]


def text_blocks(batches: Iterator[pa.RecordBatch], chars: int, cut: Callable[[str], Iterator[tuple[int, str]]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Keys, offsets and texts of batches of whole-number columns and a text in blocks of about ``chars`` characters; rows
    with a null key and null and empty texts are left out. ``keys`` has a row for each text, a column for each number.

    A text longer than a block comes in the pieces ``cut`` makes of it, each with its offset in the text.
    """
    keys: list[tuple[int, ...]] = []
    offsets: list[int] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        *numbers, column = batch.columns
        for key, value in zip(zip(*[n.to_pylist() for n in numbers]), column):
            text = value.as_py()
            if None in key or not text:
                continue
            for at, piece in cut(text) if len(text) > chars else ((0, text),):
                keys.append(key)
                offsets.append(at)
                texts.append(piece)
                size += len(piece)
                if size >= chars:
                    yield np.array(keys, np.int64), np.array(offsets, np.int64), texts
                    keys, offsets, texts, size = [], [], [], 0
    if texts:
        yield np.array(keys, np.int64), np.array(offsets, np.int64), texts


def worker_value(name: str, key: int | str, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, made once in this Python worker however many tasks it runs; another key replaces it."""
    kept = sys.modules.setdefault("_strataforge_kept", types.ModuleType("_strataforge_kept")).__dict__
    if kept.get(name, (None,))[0] != key:
        kept[name] = key, build()
    return kept[name][1]
