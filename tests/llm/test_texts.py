"""Quality rules, line dedup, exact dedup, sharding and the Jaccard join."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, awkward_texts, brute_components, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright import scale
from saleswright.llm import (
    components,
    exact_dedup,
    jaccard_join,
    line_dedup,
    quality_rules,
    sharding,
)
from saleswright.llm.cuckoo import CuckooFilter, Full
from saleswright.scale import scratch_path


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_measures(spark):
    texts = [*awkward_texts(), "a b c a b c a b", "x\nx\n \ny\nx", "#a| $%&", "... …\n- item\n• two..."]
    docs = documents(spark, texts).withColumn("n_words", F.lit("clash")).withColumn("grams", F.lit(0))
    for r in quality_rules.judged(docs).collect():
        want = measures(r["text"])
        assert tuple(r[m] for m in quality_rules.MEASURES) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_each_rule_rejects_and_prose_stays(spark):
    pick = random.Random(3)
    prose = [
        " ".join(f"word{pick.randrange(900)}" if i % 4 else "the" for i in range(200))
        for _ in range(3)
    ]
    words = prose[0].split()
    bad = {
        "short_words": " ".join("ab" if i % 9 else "of" for i in range(200)),
        "long_words": " ".join(w * 5 for w in words if w.startswith("word")),
        "symbols": " ".join(w + "$$$" for w in words),
        "exclamations": " ".join(w + "!!" for w in words),
        "capitals": prose[0].upper(),
        "stop_words": " ".join(f"noun{pick.randrange(900)}" for _ in range(200)),
        "repeated_lines": "\n".join(["the same line of words here"] * 90 + words),
        "ellipsis_lines": "\n".join(" ".join(words[i : i + 5]) + "..." for i in range(0, 200, 5)),
    }
    assert set(bad) <= {r.name for r in quality_rules.RULES}
    texts = [*prose, *bad.values()]
    assert {r[0] for r in quality_rules.passing(documents(spark, texts)).collect()} == {0, 1, 2}
    one = {name: quality_rules.Rule(name, r.measure, r.fails_if, r.bound)
           for name in bad for r in quality_rules.RULES if r.name == name}
    for i, (name, rule) in enumerate(one.items(), 3):
        measured = quality_rules.measured(documents(spark, texts).filter(F.col("doc_id") == i))
        assert measured.select(quality_rules.compiled((rule,))).first()[0], name
    assert quality_rules.passing(empty(spark)).count() == 0
    assert quality_rules.passing(documents(spark).withColumn("row", F.lit(1))).columns[-1] == "row"


def test_rules_run_no_user_function_and_no_shuffle(spark):
    plan = quality_rules.passing(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 5))
def test_permutation(n, seed):
    made = sharding.FeistelPermutation(n, seed)
    out = made.forward(np.arange(n))
    assert sorted(out.tolist()) == list(range(n))
    assert made.inverse(out).tolist() == list(range(n))


def test_shards(spark):
    docs = documents(spark, [f"t{i}" for i in range(1001)]).unionByName(
        documents(spark, ["t5", None, None])
    ).withColumn("part", F.lit("clash")).withColumn("slot", F.lit("old"))
    got = sharding.shard_rows(docs.repartition(7), ["doc_id", "text"], 24, seed=9)
    rows = got.select("doc_id", "text", "row_number", "shard", "slot").collect()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        assert sharding.row_behind(r["shard"], r["slot"], 24, len(rows), seed=9) == r["row_number"]
    assert set(by_shard) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    again = sharding.shard_rows(docs.repartition(3), ["doc_id", "text"], 24, seed=9)
    key = lambda r: (r["doc_id"], str(r["text"]), r["shard"], r["slot"])
    assert sorted(map(key, rows)) == sorted(map(key, again.collect()))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["row_number"])] == sorted(r["doc_id"] for r in rows)
    assert sharding.shard_rows(empty(spark), ["doc_id"], 24).count() == 0


def same(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("bound", [500_000, 0], ids=["sent", "shuffled"])
def test_exact_copies(spark, monkeypatch, bound):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", bound)
    texts = [*awkward_texts(), *(["hot \n copy"] * 300), "hot copy", "hot  copy"]
    docs = documents(spark, texts).withColumn("word", F.lit("clash")).withColumn("sha", F.lit(None).cast("int"))
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[same(t)].append(i)
    got = {r["doc_id"]: r for r in exact_dedup.copies(docs).collect()}
    assert len(got) == len(texts)
    for text, ids in groups.items():
        for i in ids:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (min(ids), len(ids), i == min(ids))
            assert got[i]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    first = exact_dedup.first_copies(docs)
    assert first.columns == docs.columns
    assert sorted(r["doc_id"] for r in first.collect()) == sorted(min(ids) for ids in groups.values())


def test_exact_copies_of_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, exact_dedup.copies(docs).drop("text_sha256").collect()))
    assert sum("kept=True" in x for x in got) == 3
    assert sorted(map(str, exact_dedup.first_copies(docs).collect())) == [
        "Row(doc_id=1, text='a')", "Row(doc_id=2, text='c')", "Row(doc_id=None, text='b')"
    ]
    assert exact_dedup.copies(empty(spark)).count() == 0
    assert exact_dedup.first_copies(empty(spark)).count() == 0


def test_repeat_filter_has_few_rows(spark):
    """A row for 4,096 bits, so that its bytes decide whether it is broadcast."""
    shas = spark.range(4000).select(F.sha2((F.col("id") % 2000).cast("string"), 256).alias("sha"))
    bits = exact_dedup.BITS_PER_ROW * 4000
    words = exact_dedup.repeat_filter(shas, "sha", bits)
    assert 0 < words.count() <= bits // 4096 + 1
    assert exact_dedup.maybe_repeated(shas, "sha", words, bits).filter("maybe").count() == 4000


def test_exact_dedup_stays_native(spark):
    plan = exact_dedup.copies(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 4000), st.integers(0, 2**31))
def test_cuckoo_filter(n, seed):
    random_keys = np.random.default_rng(seed)
    high, low = (random_keys.integers(-(2**63), 2**63, n) for _ in range(2))
    made = CuckooFilter.sized(n)
    try:
        made.insert(high, low)
    except Full:
        made = CuckooFilter.sized(2 * n)
        made.insert(high, low)
    made = CuckooFilter.from_bytes(made.to_bytes())
    assert made.contains(high, low).all()
    made.delete(high[: n // 2], low[: n // 2])
    assert made.contains(high[n // 2 :], low[n // 2 :]).all()
    made.delete(high[n // 2 :], low[n // 2 :])
    assert not made.table.any()


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def brute_lines(texts, min_docs):
    count = Counter(k for t in texts for k in {line_key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (line_key(x) and count[line_key(x)] >= min_docs)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_texts(n, seed):
    pick = random.Random(seed)
    lines = [f"Line {i} É" for i in range(30)] + ["", " ", "HOT line", "hot LINE  "]
    return [None, "", *("\n".join(pick.choice(lines) for _ in range(pick.randrange(6))) for _ in range(n))]


def cleaned(index, docs):
    rows = index.clean(docs).orderBy("doc_id").select("n_lines", "n_dropped", "kept_text").collect()
    return [tuple(r) for r in rows]


def members(index, every):
    """The keys of ``every`` batch that the filters of ``index`` hold."""
    blobs = {r["shard"]: bytes(r["filter"]) for r in index.filters().collect()}
    keys = every._refs().select("high", "low").distinct().collect()
    high, low = (np.array([r[c] for r in keys], "<i8") for c in ("high", "low"))
    hit = line_dedup.Filters(blobs, index.n_shards).contain(high, low)
    frequent = {tuple(r) for r in index.counts().filter(F.col("n") >= index.min_docs).select("high", "low").collect()}
    found = {(r["high"], r["low"]) for r, h in zip(keys, hit, strict=True) if h}
    assert frequent <= found
    return found


def test_documents_that_were_not_inserted_keep_their_lines(spark, monkeypatch):
    frequent = "\n".join(f"common {i}" for i in range(3000))
    index = line_dedup.LineIndex(spark, scratch_path(spark, "lines"), min_docs=2, n_shards=4).insert(documents(spark, [frequent] * 2))
    unseen = ["\n".join(f"own {k}-{i}" for i in range(20_000)) + "\nCommon 7" for k in range(10)]
    docs = documents(spark, unseen)
    blobs = {r["shard"]: bytes(r["filter"]) for r in index.filters().collect()}
    digests = [d for text in unseen for d in line_dedup.line_keys(text, 1)[1]]
    # The filters alone would take some of them.
    assert line_dedup.Filters(blobs, 4).contain(*line_dedup.halves(digests)).sum() > 10
    for sent in (line_dedup.SENT_BYTES, 0):
        monkeypatch.setattr(line_dedup, "SENT_BYTES", sent)
        assert {(r["n_lines"], r["n_dropped"]) for r in index.clean(docs).collect()} == {(20_001, 1)}


def test_line_dedup_is_reversible(spark):
    one, two = line_texts(60, 1), line_texts(50, 2)
    a, b = documents(spark, one), documents(spark, two, start=1000)
    index = line_dedup.LineIndex(spark, scratch_path(spark, "lines"), min_docs=9, n_shards=4)
    first = index.insert(a)
    assert cleaned(first, a) == brute_lines(one, 9)
    assert cleaned(first, a.withColumn("result", F.lit(1)).withColumn("n_lines", F.lit("x"))) == brute_lines(one, 9)
    both = first.insert(b)
    assert cleaned(both, a.unionByName(b)) == brute_lines(one + two, 9)
    again = both.delete(b)
    assert cleaned(again, a) == brute_lines(one, 9)
    assert sorted(map(tuple, again.counts().collect())) == sorted(map(tuple, first.counts().collect()))
    # The filters hold the keys at the bound, before and after, and none of those that fell below it.
    held = {i: members(i, again) for i in (first, both, again)}
    assert held[first] == held[again] and held[first] < held[both]
    reopened = line_dedup.LineIndex.open(spark, index.folder, min_docs=9, n_shards=4)
    assert reopened.version == 3 and cleaned(reopened, a) == brute_lines(one, 9)
    gone = again.delete(a)
    assert gone.counts().count() == 0


def test_line_dedup_ways_agree(spark, monkeypatch):
    texts = [*awkward_texts(), *line_texts(40, 3)]
    docs = documents(spark, texts)
    index = line_dedup.LineIndex(spark, scratch_path(spark, "lines"), min_docs=5, n_shards=3).insert(docs)
    assert cleaned(index, docs) == brute_lines(texts, 5)
    monkeypatch.setattr(line_dedup, "SENT_BYTES", 0)
    assert cleaned(index, docs) == brute_lines(texts, 5)


def test_lines_of_an_empty_table(spark):
    index = line_dedup.LineIndex(spark, scratch_path(spark, "lines")).insert(empty(spark))
    assert index.clean(empty(spark)).count() == 0
    assert index.counts().count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.sampled_from([80, 90, 95]), st.integers(0, 10**6))
def test_linked_sets_share_a_key_they_keep(size, percent, seed):
    """The pigeonhole, with every key at the same cost."""
    pick = np.random.default_rng(seed)
    pool = np.unique(pick.integers(0, 2**63, 2 * size + 20, dtype=np.uint64))
    a = pool[:size]
    b = np.unique(np.concatenate([a[pick.integers(0, 3) :], pool[size : size + pick.integers(0, 3 + size // 10)]]))
    same = len(np.intersect1d(a, b))
    if not len(b) or 100 * same < percent * (len(a) + len(b) - same) or np.array_equal(a, b):
        return
    bands = jaccard_join.Bands(percent)
    kept = [
        {k for _, spare, keys in bands.keys(s) for k in sorted(set(keys.tolist()))[spare:]} for s in (a, b)
    ]
    assert kept[0] & kept[1]


def near_texts(seed, groups=6, copies=14, spoil=0.06):
    """Groups of near copies, chains of them, and texts that share long passages."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(400)}"
    passage = [word() for _ in range(60)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(pick.choice([3, 9, 15, 40, 120, 300]))]
        if g % 2:
            base += passage
        now = base
        for _ in range(copies):
            now = [word() if pick.random() < spoil * pick.random() / 2 else w for w in (now if g % 3 else base)]
            texts.append(" ".join(now))
            if pick.random() < 0.3:
                texts.append(" ".join(now).upper())
    return [*texts, *awkward_texts()]


@pytest.mark.parametrize(("words", "percent", "few"), [(3, 90, 8), (5, 80, 1), (3, 90, 1)])
def test_near_classes(spark, monkeypatch, words, percent, few):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "FEW_OF_PART", few)
    texts = near_texts(words * percent + few)
    docs = documents(spark, texts).withColumn("node", F.lit("clash"))
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_classes(docs, words=words, percent=percent).collect()}
    assert got == brute_components(dict(enumerate(texts)), words, percent)


def test_one_of_each(spark):
    texts = near_texts(11)
    docs = documents(spark, texts).withColumn("whole", F.lit(1))
    kept = jaccard_join.one_of_each(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    want = {c for _, c in brute_components(dict(enumerate(texts)), 5, 80).values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "A b c d e f"), (None, None), (2, "")]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, jaccard_join.one_of_each(odd, words=5, percent=80).collect())) == sorted(
        ["Row(doc_id=1, text='a b c d e f')", "Row(doc_id=None, text=None)", "Row(doc_id=2, text='')"]
    )


def test_joins_of_empty_tables(spark):
    assert jaccard_join.near_classes(empty(spark)).count() == 0
    assert jaccard_join.one_of_each(empty(spark)).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(100, 100 + i) for i in range(1, 30)]
    edges = spark.createDataFrame([*chain, *hub, (7, 7)], "a long, b long")
    got = dict(map(tuple, components.components(edges).collect()))
    assert {got[i] for i in range(41)} == {0} and {got[100 + i] for i in range(30)} == {100}
    assert components.components(edges.limit(0)).count() == 0


def test_components_of_more_edges_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(components, "HELD", 8)
    pick = random.Random(4)
    nodes = pick.sample(range(-500, 500), 90)
    edges = [(a, b) for a, b in zip(nodes, nodes[1:], strict=False) if pick.random() < 0.9]
    least = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    met = {n for e in edges for n in e}
    want = {n: c for n, c in least.items() if n in met}
    assert dict(map(tuple, components.components(table).collect())) == want
    # Stars that a task gives before its end join the same nodes.
    halves = [pa.record_batch([pa.array(c) for c in zip(*e, strict=True)], ["a", "b"]) for e in (edges[::2], edges[1::2])]
    given = [r for b in components._forests(iter(halves)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    a, b = (np.array(c, np.int64) for c in zip(*given, strict=True))
    assert {**dict(zip(*(c.tolist() for c in components.stars(a, b)), strict=True))} == {n: c for n, c in want.items() if n != c}


def test_crc_is_of_utf8(spark):
    row = spark.range(1).select(F.crc32(F.lit("é"))).first()
    assert row[0] == zlib.crc32("é".encode())


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_without_links_keep_few_common_keys(percent):
    """A set gives up as many costly keys as its own size allows, not only as its band does."""
    bands = jaccard_join.Bands(percent)
    pick = np.random.default_rng(3)
    for size in (150, 300, 700):
        tokens = np.unique(pick.integers(0, 2**63, size, dtype=np.uint64))
        for band, spare, keys in bands.keys(tokens):
            most = max(bands.differences(size, b) for b in range(size, bands.largest_partner(size) + 1))
            if size <= bands.ends[band]:
                assert len(keys) - spare - 1 in (most, most + 1)


def test_near_copies_have_few_centers(spark):
    """The comparisons of a group of near copies grow with its nodes, not with its keys."""
    pick = random.Random(2)
    base = [f"w{pick.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(240):
        now = list(base)
        for at in (i % 30, 30 + i // 30):
            now[at] = f"x{i % 7}"
        texts.append(" ".join(now))
    docs = documents(spark, texts).select("doc_id", "text")
    sets = jaccard_join.document_sets(docs, "doc_id", "text", 3, 90)
    keys = jaccard_join.index_keys(sets)
    postings = keys.select("key", "node", F.col("node").alias("component")).distinct()
    starred = jaccard_join.starred_keys(postings, 8, True)
    pairs = starred.filter("node <> center").select("center", "node").distinct()
    assert pairs.count() <= 2 * 240
    alone = jaccard_join.starred_keys(postings, 8, False)
    assert alone.filter("node <> center").select("center", "node").distinct().count() > pairs.count()
    got = {r[2] for r in jaccard_join.near_classes(docs).collect()}
    assert got == {c for _, c in brute_components(dict(enumerate(texts)), 3, 90).values()}


def test_shared_keys_are_those_of_several_sets(spark):
    """Packed keys are the exploded ones; those of the same sets are one key."""
    docs = documents(spark, near_texts(7)).select("doc_id", "text").repartition(3)
    sets = jaccard_join.document_sets(docs, "doc_id", "text", 3, 90)
    found = {}
    for r in jaccard_join.index_keys(sets).distinct().collect():
        found.setdefault(r["key"], set()).add((r["node"], r["band"], r["spare"]))
    want = {}
    for entries in found.values():
        if len(entries) > 1:
            want[frozenset(entries)] = want.get(frozenset(entries), 0) + 1
    got = {}
    for r in jaccard_join.shared_keys(sets).collect():
        got.setdefault((r["key"], r["cost"], r["times"]), set()).add((r["node"], r["band"], r["spare"]))
    assert {frozenset(e): times for (_, _, times), e in got.items()} == want
    assert all(cost == len(e) for (_, cost, _), e in got.items())
    assert sum(want.values()) > 3 * len(want)


def test_sizes_guessed_do_not_grow_with_rounds(spark, monkeypatch):
    """Products of sizes that are carried on from round to round fill the driver."""
    bits, divided = [], jaccard_join.divided

    def seen(rows, best, percent):
        size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        bits.append(size.bit_length())
        return divided(rows, best, percent)

    monkeypatch.setattr(jaccard_join, "divided", seen)
    monkeypatch.setattr(jaccard_join, "FEW", 1)
    monkeypatch.setattr(jaccard_join, "FEW_OF_PART", 1)
    texts = near_texts(11, groups=3, copies=20, spoil=0.3)
    docs = documents(spark, texts)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_classes(docs).collect()}
    assert got == brute_components(dict(enumerate(texts)), 3, 90)
    assert 0 < max(bits) < 2000
