"""Long exact spans shared between records: the suffixes of all texts divided by prefixes, each group sorted as a suffix tree.

Two records share a stretch of ``length`` characters where two of their suffixes run together in the suffix tree down to
that depth, so the tree is needed to that depth only: below it every suffix is cut at ``length`` characters, its head.

*Prefixes.* Suffixes are divided by a prefix key: the least fingerprint among the substrings of ``prefix`` characters in
the head. Equal heads have equal keys, so all leaves of a node meet; and neighbouring suffixes mostly have the same key, so
a run of them travels as one segment of text instead of one by one. Prefixes are of variable length: a group whose different
segments have more characters than a task should hold is divided again by longer prefixes, from the texts of its segments,
until it fits. At the full length a group is one node of the tree and its leaves need only be counted.

*Steps* of one division:

1. per key, the least and the greatest record are found (partial before the shuffle); a key of one record holds nothing
   shared and its segments go no further;
2. segments that stand whole in two records are shared whole;
3. where a key has several different segments and not all are shared, one copy of each is fetched and groups are dealt to
   tasks. In a group the heads of all suffixes are sorted (but for those whose fingerprint is in one record alone: they can't
   be shared); equal neighbours in that order are the leaves of one node at
   depth ``length``, which is shared if they come from two records. Runs of shared suffixes are the maximal repeats.

Sorting compares characters. Segments are equal if their keys and two independent 64-bit fingerprints are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataforge.llm.textbuf import Fingerprints, code_points, cut_at_characters, text_blocks
from strataforge.session import materialise

#: Characters a stretch must have, and the lengths of prefixes, the last being the stretch itself.
LENGTH, PREFIXES = 200, (100, 150, 200)
#: Characters held at once when segments are cut, and when heads are sorted.
CHARS_PER_BLOCK, CHARS_PER_TREE = 2_000_000, 200_000
#: Characters of different segments a prefix group may have; a larger one is divided by longer prefixes. A task holds at most
#: a tree and a group, and for each suffix in them the bytes of its head: some 300 MB.
CHARS_PER_GROUP = 1_000_000

SEGMENT = ["key", "seg", "seg2"]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def cut_segments(texts: list[str], length: int, prefix: int, keys_only: bool = False) -> tuple[np.ndarray, ...]:
    """text number and key, start, number of suffixes and two fingerprints of every run of suffixes with one key; or the first two.

    With the full length as prefix a run's suffixes all have the same head, and the fingerprints are the head's.
    """
    symbols, starts = code_points(texts)
    count = len(symbols) - length + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(2 if keys_only else 6))
    prints = Fingerprints(symbols)
    key = sliding_min(prints.of_all(prefix), length - prefix + 1)
    text_no = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = text_no[:count] == text_no[length - 1 :]
    turn = np.empty(count + 1, bool)
    turn[0] = turn[-1] = True
    turn[1:-1] = (key[1:] != key[:-1]) | (text_no[1:count] != text_no[: count - 1])
    begins = np.flatnonzero(turn[:-1] & inside)
    if keys_only:
        return text_no[begins], key[begins].view(np.int64)
    # A run ends where the next one begins, or where suffixes become too short.
    last = np.flatnonzero(inside & (turn[1:] | ~np.append(inside[1:], False)))
    ends = (begins if prefix == length else last) + length
    seg, seg2 = prints.of(begins, ends), Fingerprints(symbols, second=True).of(begins, ends)
    return text_no[begins], key[begins].view(np.int64), begins - starts[text_no[begins]], last + 1 - begins, seg.view(np.int64), seg2.view(np.int64)


def segments(units: DataFrame, length: int, prefix: int, block: int, keys_only: bool = False) -> DataFrame:
    """key, the units' numbers (all columns but the last, the text), seg, seg2, pos and n of every segment; ``keys_only``: key and
    numbers alone, once for each block of texts."""
    names = units.columns[:-1]
    out = ["key", *names] if keys_only else [*SEGMENT, *names, "pos", "n"]
    kinds = {c: "int" if c in ("pos", "n") else "bigint" for c in out}
    schema = pa.schema([(c, pa.int32() if k == "int" else pa.int64()) for c, k in kinds.items()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, offsets, texts in text_blocks(batches, block, lambda t: cut_at_characters(t, block, length - 1)):
            no, key, *rest = cut_segments(texts, length, prefix, keys_only)
            if keys_only:
                order = np.lexsort((no, key))
                again = (np.diff(key[order], prepend=key[order][:1] + 1) == 0) & (np.diff(no[order], prepend=-1) == 0)
                no, key = no[order][~again], key[order][~again]
                found = [key, *keys[no].T]
            else:
                at, n, seg, seg2 = rest
                found = [key, seg, seg2, *keys[no].T, at + offsets[no], n]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(found, schema)], schema=schema)

    return units.mapInArrow(cut, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def sorted_heads(symbols: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions' order by the ``length`` characters that begin there, and where in that order another head begins."""
    present = np.zeros(int(symbols.max(initial=0)) + 1, bool)
    present[symbols] = True
    codes = np.cumsum(present)[symbols]  # from 1, as a zero at the end would not count
    width = max(1, (int(codes.max(initial=0)).bit_length() + 7) // 8)
    # Most significant byte first, so that comparing bytes compares characters.
    raw = np.ascontiguousarray(codes.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - width :]).ravel()
    heads = np.lib.stride_tricks.sliding_window_view(raw, length * width)[at * width]
    order = np.argsort(heads.view(f"S{length * width}").ravel())
    new = np.ones(len(order), bool)
    for part in np.array_split(np.arange(1, len(order)), len(order) // 50_000 + 1):
        new[part] = (heads[order[part]] != heads[order[part - 1]]).any(axis=1)
    return order, new


def shared_suffixes(texts: list[str], first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """For every suffix of the texts that is long enough, in order: does its head stand in two records?

    ``first`` and ``last``: least and greatest record that has the text.
    """
    symbols, starts = code_points(texts)
    heads = np.diff(starts) - (length - 1)
    text_no = np.repeat(np.arange(len(texts)), heads)
    at = np.arange(heads.sum()) - np.repeat(np.cumsum(heads) - heads, heads) + starts[text_no]
    if not len(at):
        return np.zeros(0, bool)

    def of_two(order: np.ndarray, new: np.ndarray, text_no: np.ndarray) -> np.ndarray:
        nodes = np.flatnonzero(new)
        least, most = np.minimum.reduceat(first[text_no[order]], nodes), np.maximum.reduceat(last[text_no[order]], nodes)
        out = np.empty(len(order), bool)
        out[order] = (least != most)[np.cumsum(new) - 1]
        return out

    # Equal heads have equal fingerprints: what has its fingerprint in one record alone needs no sorting.
    prints = Fingerprints(symbols).of(at, at + length)
    by_print = np.argsort(prints)
    shared = of_two(by_print, np.diff(prints[by_print], prepend=prints[by_print[:1]] + np.uint64(1)) != 0, text_no)
    left = np.flatnonzero(shared)
    if len(left):
        shared[left] = of_two(*sorted_heads(symbols, at[left], length), text_no[left])
    return shared


def _ranges(shared: np.ndarray, heads: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text number, start and end in the text of every maximal run of shared suffixes."""
    text_no = np.repeat(np.arange(len(heads)), heads)
    local = np.arange(len(shared)) - np.repeat(np.cumsum(heads) - heads, heads)
    edge = np.ones(len(shared), bool)
    edge[1:] = text_no[1:] != text_no[:-1]
    begin = np.flatnonzero(shared & (edge | ~np.append(False, shared[:-1])))
    end = np.flatnonzero(shared & (np.append(edge[1:], True) | ~np.append(shared[1:], False)))
    return text_no[begin], local[begin], local[end] + length


def _trees(grouped: DataFrame, length: int, held_chars: int, group_chars: int) -> DataFrame:
    """key, seg, seg2, begin, end of the shared parts of segments (key, seg, seg2, first, last, body).

    Each partition is sorted by key. Whole groups are held together, as many as fit; none may be larger than promised.
    """
    out = [*SEGMENT, "begin", "end"]
    schema = pa.schema([(c, pa.int64()) for c in out])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = in_group = 0

        def flush() -> pa.RecordBatch:
            key, seg, seg2, first, last = (np.array(c, np.int64) for c in zip(*[r[:5] for r in held]))
            bodies = [r[5] for r in held]
            no, begin, end = _ranges(shared_suffixes(bodies, first, last, length), np.array([len(b) for b in bodies]) - (length - 1), length)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (key[no], seg[no], seg2[no], begin, end)], schema=schema)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[-1][0]:
                    in_group = 0
                    if size >= held_chars:
                        yield flush()
                        held, size = [], 0
                held.append(row)
                size += len(row[5])
                in_group += len(row[5])
                if in_group > group_chars:
                    raise RuntimeError(f"A prefix group has more than {group_chars} characters")
        if held:
            yield flush()

    return grouped.select(*SEGMENT, "first", "last", "body").mapInArrow(build, ", ".join(f"{c} bigint" for c in out))


def _bodies(units: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted (key, seg, seg2, first, last, unit, pos, n) with the text of the segment at pos of the unit as body."""
    asked = wanted.groupBy("unit").agg(F.collect_list(F.struct(*SEGMENT, "first", "last", "pos", "n")).alias("asked"))
    # What is asked of a unit is bounded by its text; the smaller side is the one built into a table.
    both = units.select("unit", "text").join(asked.hint("shuffle_hash"), "unit").select("text", "asked")
    names = [*SEGMENT, "first", "last"]
    schema = pa.schema([*[(c, pa.int64()) for c in names], ("body", pa.string())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for text, asked_here in zip(batch.column(0), batch.column(1)):
                whole = text.as_py()
                for a in asked_here.as_py():
                    for c, v in zip(out, (*(a[x] for x in names), whole[a["pos"] : a["pos"] + a["n"] + length - 1])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return both.mapInArrow(take, ", ".join(f"{c} bigint" for c in names) + ", body string")


def _divide(units: DataFrame, length: int, prefixes: Sequence[int], block: int, tree: int, group: int) -> DataFrame:
    """unit, span_start, span_end: the stretches of units (unit, text, and first and last, the least and greatest record that
    has the text; without them a unit is a record) that stand in two records. Divided by the first of the prefixes."""
    prefix, *longer = prefixes
    of_units = "first" in units.columns
    first, last = (F.col("first"), F.col("last")) if of_units else (F.col("unit"), F.col("unit"))
    texts = units.select("unit", *["first", "last"] * of_units, "text")
    keys = segments(texts, length, prefix, block, keys_only=True).groupBy("key").agg(F.min(first).alias("a"), F.max(last).alias("z")).where("a <> z").select("key")
    kept = materialise(segments(texts, length, prefix, block).join(keys, "key"), "shared-segments")
    place = F.struct("unit", "pos")
    each = kept.groupBy(*SEGMENT).agg(F.min(first).alias("first"), F.max(last).alias("last"), F.min(place).alias("model"), F.max("n").alias("most"))
    open_ = F.col("first") == F.col("last")
    size = F.sum(F.col("most").cast("long") + length - 1)
    per_key = each.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("mixed"), F.count_if(open_).alias("open"), size.alias("chars"))
    state = each.join(per_key.select("key", F.when(F.col("mixed") & (F.col("open") > 0), F.col("chars")).alias("chars")), "key").drop("most")
    placed = materialise(kept.select(*SEGMENT, "unit", "pos", "n").join(state, SEGMENT).withColumn("model", F.col("model") == place), "placed-segments")
    whole = placed.where("first <> last").select("unit", F.col("pos").alias("span_start"), (F.col("pos") + F.col("n") + length - 1).alias("span_end"))
    if not longer:  # a group is one node
        return whole
    wanted = placed.where("model and chars is not null")
    fits = F.col("chars") <= group
    bodies = _bodies(units, wanted.where(fits), length)
    parts = _trees(bodies.repartition("key").sortWithinPartitions("key"), length, tree, group)
    large = wanted.where(~fits)
    if not large.isEmpty():
        inner = materialise(_bodies(units, large, length).withColumn("unit", F.monotonically_increasing_id()), "large-groups")
        found = _divide(inner.withColumnRenamed("body", "text"), length, longer, block, tree, group)
        named = found.join(inner.select("unit", *SEGMENT), "unit")
        parts = parts.unionByName(named.select(*SEGMENT, F.col("span_start").alias("begin"), F.col("span_end").alias("end")))
    # Those that stand whole in two records are done already; the parts are for the rest.
    rest = placed.where((F.col("first") == F.col("last")) & F.col("chars").isNotNull()).select(*SEGMENT, "unit", "pos")
    inside = rest.join(parts, SEGMENT).select("unit", (F.col("pos") + F.col("begin")).alias("span_start"), (F.col("pos") + F.col("end")).alias("span_end"))
    return whole.unionByName(inside)


def merge_spans(spans: DataFrame, *keys: str) -> DataFrame:
    """keys, span_start, span_end of the longest runs covered by spans that overlap or touch, by keys (doc_id)."""
    by = keys or ("doc_id",)
    w = Window.partitionBy(*by).orderBy("span_start", "span_end")
    reach = F.max("span_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("fresh", F.when(F.col("span_start") <= reach, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*by, "run").agg(F.min("span_start").alias("span_start"), F.max("span_end").alias("span_end")).drop("run")


def shared_spans(docs: DataFrame, length: int = LENGTH, prefixes: Sequence[int] = PREFIXES, *, block: int = CHARS_PER_BLOCK, tree: int = CHARS_PER_TREE, group: int = CHARS_PER_GROUP) -> DataFrame:
    """doc_id, span_start, span_end (code points): the longest runs of characters that lie in a stretch of ``length``
    characters which also stands in another document.

    ``prefixes`` rise and end with ``length``. Null, empty and too short texts have no spans; a document that repeats itself
    doesn't share with itself; any number of copies of a text is fine; very long texts are cut in overlapping pieces. Only
    doc_id and text are read.
    """
    if list(prefixes) != sorted(set(prefixes)) or prefixes[-1] != length:
        raise ValueError(f"prefixes must rise and end with {length}: {prefixes}")
    units = docs.select(F.col("doc_id").cast("long").alias("unit"), "text")
    return merge_spans(_divide(units, length, prefixes, block, tree, group).withColumnRenamed("unit", "doc_id"))
