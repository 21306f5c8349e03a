import base64
import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.llm import bpe, leakage, queries, spans, survivor
from strataforge.llm.textbuf import code_points, cut_at_characters, text_blocks
from tests.oracle import SF, assert_same, connect


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_agrees_with_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    if name in queries.SQL:
        assert_same(spark, connect(), df, queries.SQL[name])
    else:
        assert df.count() > 0


# --- encoding ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(open(bpe.VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_of_the_vocabulary_is_itself(encoder, reference):
    texts = [(i, reference.decode_single_token_bytes(i)) for i in range(reference.n_vocab)]
    for i, data in texts:
        try:
            assert encoder.encode_piece(data.decode()) == (i,)
        except UnicodeDecodeError:
            pass


def test_encoding_is_exact_on_random_text(encoder, reference):
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice("abtheinrsT  \n\t\r.,1e0'é́ßKKİ日本🙂\x00﻿<|endoftext|>") for _ in range(r.randint(0, 60)))
        assert encoder.encode(text) == reference.encode_ordinary(text)


def test_encoding_of_long_and_repeated_pieces(encoder, reference):
    for text in ("a" * 5001, " " * 3000 + "x", "ab" * 2500, "é" * 2000, "=" * 4000, "<|endoftext|>"):
        assert encoder.encode(text) == reference.encode_ordinary(text)
    assert len(encoder.encode("z" * 300_000)) > 0


def test_corpus_encoding(spark, reference):
    docs = spark.createDataFrame([(1, "Hello world", "x"), (2, "", "x"), (3, None, "x"), (4, "Hello world", "x"), (5, "é" * 50_000, "x")], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode_corpus(docs).collect()}
    assert got == {1: reference.encode_ordinary("Hello world"), 2: [], 3: [], 4: reference.encode_ordinary("Hello world"), 5: reference.encode_ordinary("é" * 50_000)}
    assert bpe.encode_corpus(docs.limit(0)).collect() == []


def test_documents_encode_as_the_public_tokenizer_does(spark, reference):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: list(r.ids) for r in queries.p8_ids(spark, SF).collect()}
    assert got == {r.doc_id: reference.encode_ordinary(r.text or "") for r in rows}


# --- leakage -----------------------------------------------------------------------------------------------------------


def test_fm_index_finds_all_occurrences():
    r = np.random.default_rng(2)
    for n, sigma in ((1, 2), (50, 2), (400, 3), (3000, 40)):
        text = r.integers(0, sigma, n)
        index = leakage.FMIndex(text, sigma, sample=5)
        width = 1 if n == 1 else 3
        phrases = np.array([r.integers(0, sigma, width) for _ in range(60)])
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            want = [i for i in range(n - width + 1) if (text[i : i + width] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_leaks(docs, items, words):
    found = set()
    for d, text in docs:
        w = re.findall("[a-z0-9]+", (text or "").lower())
        have = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        for i, t in items:
            v = re.findall("[a-z0-9]+", (t or "").lower())
            if any(tuple(v[k : k + words]) in have for k in range(len(v) - words + 1)):
                found.add((d, i))
    return found


@pytest.mark.parametrize("per_pass,shard", [(1_000_000, 1_000_000), (300, 500)])
def test_leakage_against_brute_force(spark, per_pass, shard):
    r = random.Random(4)
    vocab = ["aa", "bb", "CC", "d1", "Kelvin", "İx", "éé"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n> ", "é", "--"]) for _ in range(n))
    items = [(i, text(r.randint(2, 12))) for i in range(12)] + [(90, None), (91, ""), (92, "other words entirely here")]
    docs = [(i, text(r.randint(0, 40)) + "zzz " + r.choice(items)[1] if False else text(r.randint(0, 40))) for i in range(40)] + [(100, None), (101, ""), (102, items[0][1].upper()), (103, "Kelvin kelvin elvin")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    q = spark.createDataFrame(items, "item_id long, item_text string").withColumn("text", F.lit("clash"))
    got = leakage.leaked_spans(d, q, 4, per_pass=per_pass, shard=shard).collect()
    assert {(g.doc_id, g.item_id) for g in got} == brute_leaks(docs, items, 4)
    by_id = dict(docs)
    for g in got:  # the span holds whole words of the item
        inside = re.findall("[a-z0-9]+", by_id[g.doc_id][g.span_start : g.span_end].lower())
        item = " ".join(re.findall("[a-z0-9]+", dict(items)[g.item_id].lower()))
        assert len(inside) >= 4 and " ".join(inside[:4]) in item and " ".join(inside[-4:]) in item
    assert leakage.leaked_spans(d.limit(0), q, 4).count() == 0
    assert leakage.leaked_spans(d, q.limit(0), 4).count() == 0


def test_leaks_across_the_pieces_of_a_very_long_text(spark):
    """A text longer than a shard is cut at words; a passage across the cut must still be found whole."""
    passage = " ".join(f"w{i}" for i in range(30))
    texts = [(at, "x " * (at // 2) + passage + " y" * 300) for at in range(0, 1200, 37)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    q = spark.createDataFrame([(7, passage)], "item_id long, item_text string")
    got = {tuple(r) for r in leakage.leaked_spans(d, q, 10, shard=400).select("doc_id", "span_start", "span_end").collect()}
    assert got == {(k, t.index("w0"), t.index("w0") + len(passage)) for k, t in texts}


def test_cut_at_words_keeps_every_phrase_once():
    r = random.Random(12)
    text = "".join(r.choice(["ab", "c", " ", "-- ", "K", "é"]) for _ in range(400))
    words = [m.span() for m in leakage._WORDLIKE.finditer(text)]
    phrases = [(words[i][0], words[i + 2][1]) for i in range(len(words) - 2)]
    seen = []
    for at, piece in leakage.cut_at_words(text, 30, 3):
        w = [m.span() for m in leakage._WORDLIKE.finditer(piece)]
        seen += [(at + w[i][0], at + w[i + 2][1]) for i in range(len(w) - 2)]
    assert sorted(seen) == phrases


# --- shared spans ------------------------------------------------------------------------------------------------------


def brute_spans(docs, length):
    where = {}
    for d, t in docs:
        for i in range(len(t or "") - length + 1):
            where.setdefault(t[i : i + length], set()).add(d)
    out = set()
    for d, t in docs:
        t = t or ""
        shared = [False] * len(t)
        for i in range(len(t) - length + 1):
            if len(where[t[i : i + length]]) > 1:
                shared[i : i + length] = [True] * length
        i = 0
        while i < len(t):
            if shared[i]:
                j = i
                while j < len(t) and shared[j]:
                    j += 1
                out.add((d, i, j))
                i = j
            else:
                i += 1
    return out


def _some_docs(r, n, alphabet="ab🙂é"):
    pool = ["".join(r.choice(alphabet) for _ in range(r.randint(5, 60))) for _ in range(8)]
    docs = [(i, "".join(r.choice(pool) if r.random() < 0.5 else "".join(r.choice(alphabet) for _ in range(r.randint(1, 25))) for _ in range(r.randint(0, 6)))) for i in range(n)]
    return docs + [(1000, None), (1001, ""), (1002, "a" * 90), (1003, "a" * 40), (1004, docs[0][1] * 3)]


@pytest.mark.parametrize("kw", [{}, {"block": 64, "tree": 50}, {"prefixes": (10, 15, 20), "group": 100}, {"prefixes": (10, 20), "group": 1}])
def test_shared_spans_against_brute_force(spark, kw):
    r = random.Random(6)
    docs = _some_docs(r, 40)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = [tuple(x) for x in spans.shared_spans(d, 20, **{"prefixes": (10, 20), **kw}).select("doc_id", "span_start", "span_end").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spans(docs, 20)


def test_shared_spans_of_nothing_and_of_copies(spark):
    schema = "doc_id long, text string"
    assert spans.shared_spans(spark.createDataFrame([], schema), 20, (10, 20)).count() == 0
    assert spans.shared_spans(spark.createDataFrame([(1, "abc" * 50)], schema), 20, (10, 20)).count() == 0
    text = "the quick brown fox " * 20
    got = spans.shared_spans(spark.createDataFrame([(i, text) for i in range(50)], schema), 20, (10, 20)).collect()
    assert {(x.doc_id, x.span_start, x.span_end) for x in got} == {(i, 0, len(text)) for i in range(50)}


def test_heads_are_sorted_by_their_characters():
    r = random.Random(5)
    for alphabet in ("ab", "".join(map(chr, range(200, 700))) + "\0🙂", "a\U0010ffff"):
        texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(40)] + ["abcabcabc" * 5] * 2
        symbols, starts = code_points(texts)
        where = [(starts[i] + k, t[k : k + 6]) for i, t in enumerate(texts) for k in range(len(t) - 5)]
        order, new = spans.sorted_heads(symbols, np.array([w[0] for w in where]), 6)
        heads = [where[i][1] for i in order]
        assert heads == sorted(heads) and new.tolist() == [i == 0 or heads[i] != heads[i - 1] for i in range(len(heads))]


def test_a_node_is_shared_if_two_records_have_it():
    got = spans.shared_suffixes(["abcdefgh", "xbcdefgy", "abcdefgz", "short"], np.array([1, 2, 3, 4]), np.array([1, 2, 3, 4]), 6)
    assert got.tolist() == [True, True, False, False, True, False, True, True, False]


def test_ruler_lines_of_many_lengths_stay_within_a_group(spark):
    """Runs of one character have one prefix key however long they are: longer prefixes divide them, and no task holds more than
    it may (it would raise)."""
    r = random.Random(10)
    docs = [(i, f"text {i} " + "=" * (40 + i % 700) + r.choice(["", "-" * (i % 90)]) + f" end {i}") for i in range(2000)] + [(5000, "=-" * 3000), (5001, "-=" * 2000)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(x) for x in spans.shared_spans(d, 50, (25, 40, 50), tree=3_000, group=3_000).select("doc_id", "span_start", "span_end").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spans(docs, 50)


def test_a_group_larger_than_promised_raises(spark):
    d = spark.createDataFrame([(1, 2, 3, 1, 1, "a" * 30), (1, 3, 3, 2, 2, "a" * 31)], "key long, seg long, seg2 long, first long, last long, body string")
    with pytest.raises(Exception, match="more than 50 characters"):
        spans._trees(d.coalesce(1), 10, 20, 50).collect()
    assert spans._trees(d.coalesce(1), 10, 20, 61).count() == 2


def test_prefixes_must_lead_to_the_stretch(spark):
    with pytest.raises(ValueError, match="prefixes"):
        spans.shared_spans(spark.createDataFrame([], "doc_id long, text string"), 20, (20, 10))


def test_sliding_min():
    r = np.random.default_rng(3)
    for n in (0, 1, 5, 17, 100):
        v = r.integers(0, 50, n).astype(np.uint64)
        for w in (1, 3, 7):
            assert spans.sliding_min(v, w).tolist() == [min(v[i : i + w].tolist()) for i in range(n - w + 1)]


def test_text_blocks_cut_long_texts_with_overlap():
    import pyarrow as pa

    texts = ["", None, "abcdefghij", "xyz"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(texts)], names=["k", "t"])
    seen = [(int(k), int(o), t) for keys, offs, ts in text_blocks(iter([batch]), 4, lambda t: cut_at_characters(t, 4, 2)) for k, o, t in zip(keys[:, 0], offs, ts)]
    heads = sorted((k, o + i, t[i : i + 3]) for k, o, t in seen for i in range(len(t) - 2))
    assert heads == sorted([(3, i, "abcdefghij"[i : i + 3]) for i in range(8)] + [(4, 0, "xyz")])
    assert code_points(["é", "🙂a"])[0].tolist() == [0xE9, 0x1F642, 0x61]


# --- survivors ---------------------------------------------------------------------------------------------------------


STRICT = {"half_life": queries.STRICT_HALF_LIFE}


def strict(df, keys, fields, ok="ok", at="at", **kw):
    at = survivor.microseconds(F.col(at)) if dict(df.dtypes)[at].startswith("timestamp") else F.col(at)
    return survivor.survivors(df, keys, fields, trust=F.when(F.col(ok), F.lit(queries.TRUSTED_BITS)), recency=at, row_id=F.col("id"), **STRICT, **kw)


@pytest.mark.parametrize("rows_per_group", [survivor.ROWS_PER_GROUP, 3])
def test_survivors_against_brute_force(spark, rows_per_group):
    r = random.Random(8)
    day = lambda: r.choice([None, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)] + [dt.datetime(2025, 1, r.randint(1, 3), microsecond=r.choice([0, 1]))] * 3)
    rows = [(r.choice(["a", "b", None]), i, r.choice([True, False, None]), day(), r.choice([None, "X", " x", "y"]), r.choice([None, 1, 2])) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, id int, ok boolean, at timestamp_ntz, s string, n int").withColumns({"value": F.lit(1), "votes": F.lit(1), "_f0": F.lit(1)})
    got = {x.k: x for x in strict(df, ["k"], {"s": F.col("s"), "n": F.col("n")}, rows_per_group=rows_per_group).collect()}
    for k in ("a", "b", None):
        for f, at in (("s", 4), ("n", 5)):
            mine = [x for x in rows if x[0] == k and x[at] is not None]
            best = max(mine, key=lambda x: (bool(x[2]), x[3] is not None, x[3] or dt.datetime.min, x[1]))
            assert (got[k][f].row_id, got[k][f].value) == (best[1], str(best[at]))
    assert strict(df.limit(0), ["k"], {"s": F.col("s")}).collect() == []


@pytest.mark.parametrize("rows_per_group", [survivor.ROWS_PER_GROUP, 7])
def test_votes_are_trust_times_decay(spark, rows_per_group):
    """Sums against a plain computation: trust weights, half-lives, and rows that count or don't."""
    r = random.Random(9)
    rows = [(r.choice("pq"), i, r.choice([0, 1, 3]), r.randint(0, 40), r.choice(["a", "A ", "b", "c"])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, id int, bits int, day int, s string")
    got = {x.k: x.s for x in survivor.survivors(df, ["k"], {"s": F.col("s")}, trust=F.col("bits"), recency=F.col("day"), row_id=F.col("id"), half_life=8, every_row=True, rows_per_group=rows_per_group).collect()}
    for k in "pq":
        sums = {}
        for _, i, bits, day, v in (x for x in rows if x[0] == k):
            sums[v.strip().lower()] = sums.get(v.strip().lower(), 0) + 2 ** (bits + day / 8)
        best = max(sums, key=sums.get)
        top = 2 ** int(max(x[2] + x[3] / 8 for x in rows if x[0] == k))  # the whole part of the strongest vote's exponent
        assert got[k].value.strip().lower() == best and float(got[k].votes) == pytest.approx(sums[best] / top)


def test_many_weak_votes_beat_a_strong_one_unless_precedence_is_strict(spark):
    rows = [("k", 1, True, 100, "new")] + [("k", 2 + i, True, 90 - i, "old") for i in range(5)] + [("k", 9, False, 101, "untrusted")]
    df = spark.createDataFrame(rows, "k string, id int, ok boolean, day int, s string")
    s = {"s": F.col("s")}
    mild = survivor.survivors(df, ["k"], s, trust=F.when(F.col("ok"), 1), recency=F.col("day"), row_id=F.col("id"), half_life=30).first().s
    assert (mild.value, mild.row_id) == ("old", 2) and float(mild.votes) == pytest.approx(sum(2 ** ((90 - i) / 30 - 100 // 30) for i in range(5)))
    hard = strict(df, ["k"], s, at="day").first().s
    assert (hard.value, hard.row_id) == ("new", 1)


def test_precedence_is_strict_in_large_groups(spark):
    """One newest row wins against any number of older ones with another value; all of them have been counted."""
    df = spark.range(1, 3001).select(F.lit("k").alias("k"), "id", F.when(F.col("id") == 3000, "new").otherwise("old").alias("s"), F.lit(True).alias("ok"))
    one = strict(df, ["k"], {"s": F.col("s")}, at="id").first()
    assert one.s.value == "new" and one.s.row_id == 3000


def test_groups_that_give_no_row(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, None), ("single", 3, "x"), ("copies", 4, "y"), ("copies", 5, "z")], "k string, id int, s string").withColumn("ok", F.lit(True))
    got = strict(df, ["k"], {"s": F.col("s")}, at="id", at_least=2, votes=F.col("id") != 5).collect()
    assert [(x.k, x.s.row_id) for x in got] == [("copies", 4)]


def test_very_long_texts_are_encoded_piece_by_piece(monkeypatch, encoder, reference):
    monkeypatch.setattr(bpe, "LISTED_CHARS", 3)
    text = "Some words, 12345 and\n\n  others' things"
    assert encoder.encode(text) == reference.encode_ordinary(text)
