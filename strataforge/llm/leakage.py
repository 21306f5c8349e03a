"""Evaluation passages in training text: a full-text index (FM-index) of each training shard, searched for test phrases.

Texts become sequences of words, words become symbols. The alphabet is the words of the test items; a run of other words
is one separator, since no phrase can reach across it, and stretches between separators that are shorter than a phrase
are left out, since none fits in. What remains of a shard is indexed: its suffixes are sorted, the Burrows-Wheeler
transform is held in a wavelet matrix, and all phrases - every ``words`` consecutive words of every item - are searched
backwards at once, two rank queries a word. Occurrences are located by walking to the next sampled suffix position,
mapped to documents, checked word by word against the text, and overlapping ones of an item merged into spans.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.spans import merge_spans
from strataforge.llm.textbuf import Fingerprints, text_blocks, worker_value
from strataforge.session import materialise

#: Words a passage must have.
WORDS = 10
#: Characters of training text in one index, and of test items searched in one pass over the corpus.
CHARS_PER_SHARD, CHARS_PER_PASS = 4_000_000, 8_000_000
#: Every so many text positions the index remembers where it is.
SAMPLE = 8
SEPARATOR = 0

_SPANS = "doc_id bigint, item_id bigint, span_start bigint, span_end bigint"
_WORD = re.compile(r"[a-z0-9]+")
#: Stretches no cut may go through: all that can be in a word, whatever its case.
_WORDLIKE = re.compile("[A-Za-z0-9\u0130\u212a]+")
#: 1 to 36 for what can stand in a word, upper case as lower case; 0 for all other bytes.
_LETTER = np.zeros(256, np.uint8)
for _i, _c in enumerate(b"0123456789abcdefghijklmnopqrstuvwxyz"):
    _LETTER[_c] = _LETTER[bytes([_c]).upper()[0]] = _i + 1


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _plain(text: str) -> bytes:
    """The text in UTF-8, the only two characters outside ASCII whose lower case holds an ASCII letter written as that letter:
    the Kelvin sign as k, the dotted capital I as i and a byte that separates. Counted without continuation bytes, it has
    as many characters as the text."""
    data = text.encode("utf-8", "surrogatepass")
    return data.replace(b"\xe2\x84\xaa", b"k").replace(b"\xc4\xb0", b"i\x80")


def _chars(data: bytes) -> int:
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def cut_at_words(text: str, chars: int, words: int) -> Iterator[tuple[int, str]]:
    """Offset and text of pieces of about ``chars`` characters that end with a whole word and begin words - 1 words before the
    end of the piece before, so that every ``words`` consecutive words lie in exactly one piece."""
    begin, recent, end = 0, deque(maxlen=max(1, words - 1)), 0
    for word in _WORDLIKE.finditer(text):
        end = word.end()
        recent.append(word.start())
        if end - begin >= chars and recent[0] > begin:
            yield begin, text[begin:end]
            begin, end = recent[0], 0
    if end:
        yield begin, text[begin:end]


class WaveletMatrix:
    """rank(c, i): how often symbol c stands before position i; one pass over the bits of c."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        level = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            count = np.zeros(len(level) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(level) - int(count[-1]))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        lo = np.zeros(len(c), np.int64)
        hi = i.astype(np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = (c >> (self.bits - 1 - k)) & 1 == 1
            lo_ones, hi_ones = ones[lo], ones[hi]
            lo = np.where(up, zeros + lo_ones, lo - lo_ones)
            hi = np.where(up, zeros + hi_ones, hi - hi_ones)
        return hi - lo


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the sorted length until all differ."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    width = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width] = rank[width:] + 1
        pair = rank * (n + int(rank.max()) + 2) + ahead
        order = np.argsort(pair, kind="stable")
        step = np.zeros(n, np.int64)
        step[1:] = pair[order][1:] != pair[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        width *= 2
        if int(step.sum()) == n - 1 or width >= n:
            return order


class FMIndex:
    """Searches a sequence of symbols 0 <= s < sigma for many phrases at once."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE) -> None:
        # One symbol below all others ends the sequence.
        text = np.append(symbols.astype(np.int64) + 1, 0)
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, sigma + 1)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        self.marked = order % sample == 0
        self.mark_no = np.cumsum(self.marked) - 1
        self.positions = order[self.marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each row of phrases."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.bwt), np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k] + 1
            lo[live] = self.below[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.below[c] + self.wavelet.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
        dead = hi <= lo
        lo[dead] = hi[dead] = 0
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes at these rows: back to the nearest sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.marked[at])
        while len(open_):
            c = self.bwt[at[open_]]
            at[open_] = self.below[c] + self.wavelet.rank(c, at[open_])
            steps[open_] += 1
            open_ = open_[~self.marked[at[open_]]]
        return self.positions[self.mark_no[at]] + steps


class Phrases:
    """The test items of one pass: their words as symbols and every phrase with the items it stands in."""

    def __init__(self, items: list[tuple[int, str]], words: int) -> None:
        self.words = words
        in_words = [(item_id, words_of(text)) for item_id, text in items]
        self.vocabulary = sorted({w for _, ws in in_words for w in ws})
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item_id, ws in in_words:
            for i in range(len(ws) - words + 1):
                owners.setdefault(tuple(number[w] for w in ws[i : i + words]), set()).add(item_id)
        self.phrases = np.array(list(owners), np.int64).reshape(len(owners), words)
        self.owners = [sorted(o) for o in owners.values()]
        letters = [_LETTER[np.frombuffer(w.encode(), np.uint8)] for w in self.vocabulary]
        prints = np.array([Fingerprints(x).of(np.array([0]), np.array([len(x)]))[0] for x in letters], np.uint64)
        self.order = np.argsort(prints)
        self.prints = prints[self.order]

    def symbols(self, prints: np.ndarray) -> np.ndarray:
        """The symbols of words with these fingerprints; the separator for words no item has."""
        at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        return np.where(self.prints[at] == prints, self.order[at] + 1, SEPARATOR)


def _shard_words(texts: list[str], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Symbol, text number, begin and end in bytes of every word of the shard, where its texts begin, and its bytes."""
    encoded = [_plain(t) for t in texts]
    data = b"\n".join(encoded) + b"\n"
    letter = _LETTER[np.frombuffer(data, np.uint8)]
    inside = np.concatenate([[False], letter > 0])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turn[0::2], turn[1::2]
    symbol = phrases.symbols(Fingerprints(letter).of(begin, end))
    starts = np.cumsum([0] + [len(e) + 1 for e in encoded])
    text_no = np.searchsorted(starts, begin, side="right") - 1
    return symbol, text_no, begin, end, starts, data


def search_shard(texts: list[str], phrases: Phrases) -> list[tuple[int, int, int, int]]:
    """text number, item, begin and end in characters of every merged span."""
    if not len(phrases.phrases):
        return []
    symbol, text_no, begin, end, starts, data = _shard_words(texts, phrases)
    n, words = len(symbol), phrases.words
    # Stretches of known words within one text; those a phrase fits in are kept, each followed by a separator.
    known = symbol != SEPARATOR
    if not known.any():
        return []
    fresh = np.ones(n, bool)
    fresh[1:] = ~known[:-1] | (text_no[1:] != text_no[:-1])
    stretch = np.cumsum(fresh & known)
    kept = known & (np.bincount(stretch[known], minlength=int(stretch[-1]) + 1)[stretch] >= words)
    where = np.flatnonzero(kept)
    if not len(where):
        return []
    first = np.ones(len(where), bool)
    first[1:] = stretch[where][1:] != stretch[where][:-1]
    shift = np.cumsum(first)  # a separator goes in before each stretch
    sequence = np.full(len(where) + int(shift[-1]), SEPARATOR, np.int64)
    sequence[np.arange(len(where)) + shift] = symbol[where]
    word_at = np.zeros(len(sequence), np.int64)
    word_at[np.arange(len(where)) + shift] = where
    index = FMIndex(sequence, len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.phrases)
    count = hi - lo
    phrase = np.repeat(np.arange(len(count)), count)
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    at = word_at[index.locate(rows)]
    by_text_and_item: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for p, w in zip(phrase.tolist(), at.tolist()):
        here = [data[b:e].lower().decode() for b, e in zip(begin[w : w + words].tolist(), end[w : w + words].tolist())]
        if here == [phrases.vocabulary[s - 1] for s in phrases.phrases[p]]:
            for item in phrases.owners[p]:
                by_text_and_item.setdefault((int(text_no[w]), item), []).append((w, w + words))
    out = []
    for (t, item), found in sorted(by_text_and_item.items()):
        merged: list[list[int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            head = _chars(data[starts[t] : begin[a]])
            out.append((t, item, head, head + _chars(data[begin[a] : end[b - 1]])))
    return out


def _search_pass(docs: DataFrame, items: list[tuple[int, str]], words: int, chars: int) -> DataFrame:
    text = json.dumps(items)
    told, key = docs.sparkSession.sparkContext.broadcast(text), f"{words}-{hashlib.sha256(text.encode()).hexdigest()}"
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "span_start", "span_end")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = worker_value("phrases", key, lambda: Phrases([tuple(x) for x in json.loads(told.value)], words))
        for keys, offsets, texts in text_blocks(batches, chars, lambda t: cut_at_words(t, chars, words)):
            found = search_shard(texts, phrases)
            if found:
                t, item, begin, end = (np.array(c, np.int64) for c in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[t, 0], item, begin + offsets[t], end + offsets[t])], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(search, _SPANS)


def leaked_spans(docs: DataFrame, items: DataFrame, words: int = WORDS, *, shard: int = CHARS_PER_SHARD, per_pass: int = CHARS_PER_PASS) -> DataFrame:
    """doc_id, item_id, span_start, span_end (code points): where ``words`` or more consecutive words of an item stand.

    ``docs``: doc_id, text; ``items``: item_id, item_text. The corpus stays where it is: each task indexes and searches its
    own shards. Items are gathered in blocks of at most ``per_pass`` characters, each searched in its own pass over the
    corpus. Null and empty texts and items shorter than ``words`` words match nothing. Very long texts are cut at words and their
    spans put together again.
    """
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), "item_text").where("item_id is not null and item_text is not null")
    total = usable.agg(F.sum(F.length("item_text"))).first()[0] or 0
    passes = max(1, -(-2 * total // per_pass)) if total > per_pass else 1
    found = None
    for i in range(passes):
        block = usable if passes == 1 else usable.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i)
        one = _search_pass(docs, [(r.item_id, r.item_text) for r in block.collect()], words, shard)
        one = one if passes == 1 else materialise(one, "leaked-spans")
        found = one if found is None else found.unionByName(one)
    # Spans that reach over the cut of a very long text come in parts.
    return merge_spans(found, "doc_id", "item_id")
