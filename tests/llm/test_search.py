"""Spelling variants, periodic runs and the positional index against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, WORD, awkward_texts, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright import scale
from saleswright.llm import periodic_runs, positional_index, queries_search, spelling
from saleswright.scale import scratch_path

# -- spelling variants ---------------------------------------------------------------


def near(a, b):
    """Whether exactly one inserted, deleted or replaced character tells two words apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts, times):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(v, w)]
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        has = best is not None and counts[best] >= times * n
        out[w] = [n, len(others), best if has else None, counts[best] if has else None]
    for w in out:
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def vocabulary(pick, alphabet, n, top):
    return {"".join(pick.choice(alphabet) for _ in range(pick.randrange(top + 1))): 10 ** pick.randrange(5) + pick.randrange(2) for _ in range(n)}


@pytest.mark.parametrize("alphabet,n,top", [("ab", 60, 6), ("aé日", 120, 4), ("abcdefgh", 150, 3), ("a", 9, 8)])
def test_variants(spark, alphabet, n, top):
    counts = vocabulary(random.Random(n), alphabet, n, top)
    words = spark.createDataFrame([(w, c) for w, c in counts.items()], "word string, n long")
    for times in (2, 10):
        got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(words, times).collect()}
        assert got == brute_variants(counts, times)
    pairs = [tuple(r) for r in spelling.neighbours(words).collect()]
    assert len(set(pairs)) == len(pairs)
    assert set(pairs) == {(a, b) for a in counts for b in counts if near(a, b)}


def test_words_that_are_odd(spark):
    rows = [("abc", 3), ("abc", 4), (None, 9), ("", 1), ("a", 50), ("a\u0000b", 5), ("a\u0000c", 5), ("abd", 100)]
    words = spark.createDataFrame([(*r, "x") for r in rows], "word string, n long, prefix string")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(words).collect()}
    assert got == {
        "abc": (7, 1, "abd", 100, "abd"), "abd": (100, 1, None, None, "abd"), "": (1, 1, "a", 50, "a"),
        "a": (50, 1, None, None, "a"), "a\u0000b": (5, 0, None, None, "a\u0000b"), "a\u0000c": (5, 0, None, None, "a\u0000c")}
    assert spelling.variants(words.limit(0)).count() == 0
    assert spelling.neighbours(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(words, 1)


def brute_runs_of_letters(rows, one_in):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and check % one_in == 0:
                i = check % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return counts


def test_counts_of_runs(spark):
    texts = [*awkward_texts(), "ÀÉÎ×÷ Überraschung überraschung ÜBERRASCHUNG İstanbul straße", "aaaaaaaa AAAAAAAA aaaaaaa", "x" * 50]
    docs = documents(spark, texts).withColumn("word", F.lit(1)).withColumn("check", F.lit("old"))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id")))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for one_in in (None, 2, 31):
        for least, times in ((7, 2), (1, 1)):
            got = {r["word"]: r["n"] for r in spelling.run_counts(docs, min_chars=least, min_count=times, typo_one_in=one_in).collect()}
            assert got == {w: n for w, n in brute_runs_of_letters(rows, one_in).items() if len(w) >= least and n >= times}
    assert spelling.run_counts(empty(spark)).count() == 0


def test_groups_are_bounded_by_the_alphabet(spark):
    words = spark.createDataFrame([(f"{a}{b}{c}", 1) for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"], "word string, n long")
    assert spelling.rotations(words).groupBy("prefix").count().agg(F.max("count")).first()[0] <= 11
    got = spelling.variants(words)
    assert {r["n_near"] for r in got.collect()} == {27}


# -- periodic runs --------------------------------------------------------------------


def brute_runs(words, min_length=24, times=3):
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > start and i - start + p >= max(min_length, times * p):
                found.setdefault((start, i - start + p), p)
            i += i == start
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(pick):
    texts = []
    for _ in range(40):
        n, kinds = pick.choice([0, 23, 24, 60, 300, 900]), pick.choice([1, 2, 3, 40])
        words = [f"w{pick.randrange(kinds)}" for _ in range(n)]
        for _ in range(pick.randrange(3) if n else 0):
            a = pick.randrange(n)
            p = 1 + (n - a) // (3 + pick.randrange(8))
            stop = pick.randrange(a, n + 1)
            words[a:stop] = [words[a + (i - a) % p] for i in range(a, stop)]
        texts.append(pick.choice([" ", "\n", " \t "]).join(words))
    return texts


def test_runs_of_documents(spark, monkeypatch):
    texts = [*periodic_texts(random.Random(2)), *awkward_texts(), "a b " * 30, "\x1cx " * 24, "na " * 5000, *periodic_texts(random.Random(2))[:9]]
    docs = documents(spark, texts).withColumn("runs", F.lit("old")).withColumn("found", F.lit(7)).withColumn("a`b.c", F.lit(1))
    for size in (1, periodic_runs.SLICE_BYTES):
        monkeypatch.setattr(periodic_runs, "SLICE_BYTES", size)
        for min_length, times in ((24, 3), (4, 2)):
            rows = periodic_runs.periodic_runs(docs, "text", min_length, times).collect()
            assert len(rows) == len(texts)
            for r in rows:
                words = WORD.findall(r["text"] or "")
                # The two texts of 20,000 random words have no runs; all others are compared.
                want = [] if len(words) > 6000 else brute_runs(words, min_length, times)
                assert [tuple(x) for x in r["runs"]] == want
                assert (r["n_words"], r["collapsed"]) == (len(words), brute_collapsed(words, want))
    assert rows[0].asDict()["found"] == 7 and "a`b.c" in rows[0].asDict()
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, times=1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=400), st.integers(1, 60), st.integers(0, 2**32))
def test_common_extensions(ids, period, seed):
    pick = random.Random(seed)
    ids = ids + [ids[i % min(period, len(ids))] for i in range(300)]
    array = np.array(ids, np.int32)
    table = periodic_runs.CommonExtensions(array)
    n = len(ids)

    def common(a, b):
        k = 0
        while b + k < n and ids[a + k] == ids[b + k]:
            k += 1
        return k

    for _ in range(40):
        a, b = sorted((pick.randrange(n), pick.randrange(n)))
        want = common(a, b) if a < b else 0
        if want >= periodic_runs.COVER:
            assert table.of(np.array([a]), np.array([b]))[0] == want


def test_the_cover_meets_all_differences():
    places = periodic_runs.PLACES.tolist()
    assert {(a - b) % periodic_runs.COVER for a in places for b in places} == set(range(periodic_runs.COVER))


def test_planted_periods_and_digests(spark):
    texts = [*periodic_texts(random.Random(4)), None, ""]
    docs = documents(spark, texts)
    planted = {r["doc_id"]: r["text"] for r in queries_search.with_planted_periods(docs).collect()}
    changed = 0
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        n, check = len(words), zlib.crc32(str(i).encode())
        if check % 10 == 0 and n:
            g = check // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
            changed += 1
        assert WORD.findall(planted[i] or "") == words
    assert changed > 1


# -- positional index -------------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def occurrences(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def index_of(spark, docs):
    path = scratch_path(spark, "positions-test")
    positional_index.write_index(docs, path)
    return positional_index.PositionalIndex(spark, path)


def corpus(pick):
    vocabulary = ["the", "Of", "a", "rare1", "rare2", "çà", "日本", "x9", "Cat", "dog"]
    weights = [30, 20, 20, 1, 1, 3, 3, 3, 5, 5]
    made = [" ".join(pick.choices(vocabulary, weights, k=pick.choice([0, 1, 5, 40, 200]))) for _ in range(60)]
    items = [" ".join(pick.choices(vocabulary, weights, k=pick.choice([1, 3, 6, 14]))) for _ in range(25)]
    for i, item in enumerate(items):
        made[i] = made[i] + "; " + item.upper().replace("À", "à").replace("Ç", "ç") + ". " + made[i + 1]
    return made, items


@pytest.mark.parametrize("segment,block,rows", [(200, 3, 500_000), (8 << 20, 50_000, 500_000), (2000, 7, 0)])
def test_phrases(spark, monkeypatch, segment, block, rows):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(scale, "BROADCAST_ROWS", rows)
    made, items = corpus(random.Random(segment))
    docs = documents(spark, [*made, *awkward_texts(), *made[:5]]).withColumn("term", F.lit("old")).withColumn("n", F.lit(1)).repartition(3)
    texts = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    index = index_of(spark, docs)
    phrases = sorted({" ".join(tokens(x)[:4]) for x in items}) + ["nowhere the", "the nowhere"]
    table = spark.createDataFrame([(p, p.split(" ")) for p in phrases] + [("none", []), ("null", None), ("part", ["the", None]), ("empty", [""])], "phrase string, words array<string>")
    keys = {(r["segment"], r["doc_no"]): r["key"] for r in index.documents().collect()}
    assert sorted(keys.values()) == sorted(texts)
    assert {r["key"]: r["n_words"] for r in index.documents().collect()} == {k: len(w) for k, w in texts.items()}
    found = sorted((keys[r["segment"], r["doc_no"]], r["start"], r["length"], r["phrase"]) for r in index.search(table, block_phrases=block).collect())
    want = sorted((k, i, len(p.split(" ")), p) for k, w in texts.items() for p in phrases for i in occurrences(w, p.split(" ")))
    assert found == want and len(want) > 20


def test_proximity(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", 500)
    made, _ = corpus(random.Random(11))
    docs = documents(spark, made)
    texts = {r["doc_id"]: tokens(r["text"]) for r in docs.collect()}
    index = index_of(spark, docs)
    keys = {(r["segment"], r["doc_no"]): r["key"] for r in index.documents().collect()}
    counts = Counter(w for t in texts.values() for w in t)
    phrase = ["the", "dog", "rare1"]
    lead = min(phrase, key=lambda w: (counts[w], phrase.index(w)))
    table = spark.createDataFrame([("p", phrase)], "phrase string, words array<string>")
    for within in (1, 4, 30):
        want = []
        for k, words in texts.items():
            for at, w in enumerate(words):
                if w != lead:
                    continue
                best = [min((abs(j - at), j) for j in range(len(words)) if words[j] == o) if o in words else (10**9, 0) for o in phrase if o != lead]
                if all(d <= within for d, _ in best):
                    low, high = min([at, *(j for _, j in best)]), max([at, *(j for _, j in best)])
                    want.append((k, low, high - low + 1))
        got = sorted((keys[r["segment"], r["doc_no"]], r["start"], r["length"]) for r in index.search(table, within=within).collect())
        assert got == sorted(want)
    assert want


def brute_contamination(texts, items, size):
    windows = defaultdict(set)
    for item, text in items:
        words = tokens(text)
        for i in range(max(len(words) - size, 0) + 1 if words else 0):
            windows[tuple(words[i : i + size])].add("" if item is None else str(item))
    out = []
    for key, text in texts:
        words, hit, found = tokens(text), set(), set()
        for window, owners in windows.items():
            for i in occurrences(words, list(window)):
                hit |= set(range(i, i + len(window)))
                found |= owners
        out.append((key, len(words), len(hit), sorted(found, key=str.encode)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1, 3, 10])
def test_contamination(spark, monkeypatch, size):
    monkeypatch.setattr(positional_index, "SEGMENT_BYTES", 700)
    made, texts = corpus(random.Random(size))
    items = [(i % 20, t) for i, t in enumerate(texts)] + [(None, texts[0]), (99, None), (98, " ;"), (97, texts[3])]
    docs = documents(spark, [*made, *awkward_texts()]).withColumn("doc_id", F.when(F.col("doc_id") != 5, F.col("doc_id")))
    benchmark = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, phrase string")
    index = index_of(spark, docs)
    rows = positional_index.contamination(index, benchmark, size).collect()
    got = sorted(((r["key"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=repr)
    assert got == brute_contamination([(r["doc_id"], r["text"]) for r in docs.collect()], items, size)
    for r in rows:
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_hit"]
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))
    assert positional_index.contamination(index_of(spark, empty(spark)), benchmark).count() == 0
    assert positional_index.contamination(index, benchmark.limit(0)).filter("n_hit > 0").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**30), min_size=1, max_size=60))
def test_packed_positions(gaps):
    data, ends = positional_index.pack_gaps(np.array(gaps))
    assert len(data) == ends[-1]
    assert positional_index.positions_of(data.tobytes()).tolist() == np.cumsum(gaps).tolist()


def test_words_are_cut_as_the_pattern_does():
    texts = [*awkward_texts(), "A-B_c d9é\x7fz\u0080ÀZ", "\x00\x01", "''"]
    words, starts = positional_index.split_words(pa.array(texts, pa.string()))
    assert [words.slice(a, b - a).to_pylist() for a, b in zip(starts, starts[1:], strict=False)] == [tokens(t) for t in texts]
