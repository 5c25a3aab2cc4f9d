"""The classifier on held-out labels, its shrinking, chat formatting and the pipeline."""

import random

import pytest
from helpers import documents, empty
from pyspark.sql import functions as F

import corpus_pipeline
from saleswright.llm import chat, site_quality
from saleswright.llm.queries_text import GOOD

FOLDER = "/root/testdata/sf0.01"


def toy(spark, n=400):
    pick = random.Random(8)
    rows = []
    for i in range(n):
        good = pick.random() < 0.7
        words = [f"w{pick.randrange(300)}" for _ in range(30)] + ([] if good else ["awful", "trash"])
        rows.append((i, " ".join(words), f"host{i % 5}", "p", int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, quality int")
    return docs.drop("quality"), docs.select("doc_id", "quality", F.lit(0).alias("toxic"))


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.filter("doc_id % 3 <> 0")
    fitted = site_quality.fit_evidence(docs, seen, GOOD)
    scored = site_quality.site_scores(docs, fitted).select("doc_id", "score", "kept")
    held = scored.join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    clean = [r["kept"] for r in held if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r["kept"] for r in held if r["quality"] == 0]
    assert sum(clean) >= 0.97 * len(clean)
    assert sum(poor) <= 0.2 * len(poor)


def test_awkward_rows(spark):
    docs, labels = toy(spark)
    fitted = site_quality.fit_evidence(docs, labels, GOOD)
    odd = documents(spark).withColumn("host", F.lit(1)).withColumn("score", F.lit("clash"))
    for settle in (False, True):
        rows = site_quality.site_scores(odd, fitted, settle=settle).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= site_quality.THRESHOLD) for r in rows)
    assert site_quality.good_sites(odd, fitted).columns == odd.columns
    assert site_quality.site_scores(empty(spark), fitted).count() == 0


def test_labels_that_fit_nothing(spark):
    docs, labels = toy(spark, 40)
    none = site_quality.fit_evidence(docs, labels.limit(0), GOOD)
    assert none.model is None and none.share == 1.0
    one = site_quality.fit_evidence(docs, labels.withColumn("quality", F.lit(1)), GOOD)
    assert one.model is None and one.share == 1.0
    null = site_quality.fit_evidence(docs, labels.withColumn("quality", F.lit(None).cast("int")), GOOD)
    assert null.model is None
    assert site_quality.good_sites(docs, none).count() == 40


def test_sites_shrink_by_their_size(spark):
    rows = [("bad", "p", 0.05)] * 300 + [("good", "p", 0.95)] * 300 + [("good", "q", 0.1)]
    rows += [("tiny", "p", 0.05)]
    chances = spark.createDataFrame(rows, "host string, path string, chance double")
    sites, share, host_weight, path_weight = site_quality.site_posteriors(chances)
    host = {(r["host"], r["path"]): r for r in sites.collect()}

    def posterior(h, p):
        r = host[h, p]
        at_host = (r["host_good"] + host_weight * share) / (r["host_n"] + host_weight)
        return (r["good"] + path_weight * at_host) / (r["n"] + path_weight)

    assert posterior("bad", "p") < 0.1 < 0.9 < posterior("good", "p")
    assert posterior("good", "q") > 0.3  # one poor document on a good host
    assert posterior("bad", "p") < posterior("tiny", "p") < share
    alike = spark.createDataFrame([("a", "p", 0.5)] * 50 + [("b", "p", 0.5)] * 50, chances.schema)
    assert site_quality.site_posteriors(alike)[2] == site_quality.STRONGEST


@pytest.fixture
def turns(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é"), (1, 2, "bob", None), (1, 3, "ann", "Bye 🙂"),
        (2, 5, None, "alone"), (3, 0, "system", "only"), (None, 1, "x", "n1"), (None, 2, "y", "n2"),
        (4, None, "a", "first"), (4, 1, "a", "tie"), (4, 1, "a", "tie"), (4, 70, "b", "next page"),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_perspectives(turns):
    got = chat.perspectives(turns.withColumn("page", F.lit("clash"))).collect()
    seen = {(r["conversation"], r["speaker"], r["page"]): r for r in got}
    assert set(seen) == {
        (1, "ann", 0), (1, "bob", 0), (2, "unknown", 0), (None, "x", 0), (None, "y", 0),
        (4, "a", 0), (4, "a", 1), (4, "b", 0), (4, "b", 1),
    }
    ann = seen[1, "ann", 0]
    assert ann["text"] == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi é<|im_end|>\n"
        "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\nBye 🙂<|im_end|>\n"
    )
    assert [ann["text"][s["start"] : s["end"]] for s in ann["spans"]] == ["Hi é<|im_end|>", "Bye 🙂<|im_end|>"]
    assert ann["n_masked"] == sum(s["end"] - s["start"] for s in ann["spans"])
    assert seen[4, "a", 0]["n_turns"] == 3 and seen[4, "a", 1]["spans"] == []
    assert chat.perspectives(turns.limit(0)).count() == 0


def test_pages_join_to_the_whole(turns):
    small = chat.perspectives(turns, page_turns=2).orderBy("page").collect()
    whole = chat.perspectives(turns, page_turns=1000).collect()
    for r in whole:
        parts = [p["text"] for p in small if (p["conversation"], p["speaker"]) == (r["conversation"], r["speaker"])]
        assert "".join(parts) == r["text"]


def test_pages_are_bounded_whatever_the_turn_numbers(spark):
    hot = spark.range(1000).select(
        F.lit(None).cast("long").alias("conv_id"),
        F.when(F.col("id") % 9 < 8, F.col("id") % 9 + F.when(F.col("id") % 2 == 0, 100).otherwise(0)).alias("turn"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("role"),
        F.when(F.col("id") < 500, "same").otherwise(F.col("id").cast("string")).alias("text"),
    )
    short = spark.createDataFrame([(1, 0, "c", "x"), (1, 70, "d", "y")], hot.schema)
    got = chat.perspectives(hot.union(short)).orderBy("page").collect()
    whole = chat.perspectives(hot.union(short), page_turns=10**6).collect()
    assert max(r["n_turns"] for r in got) <= 64
    assert len({(r["conversation"], r["speaker"], r["page"]) for r in got}) == len(got)
    for r in whole:
        parts = [p for p in got if (p["conversation"], p["speaker"]) == (r["conversation"], r["speaker"])]
        assert "".join(p["text"] for p in parts) == r["text"]
        assert sum(p["n_turns"] for p in parts) == r["n_turns"] == (1000 if r["conversation"] is None else 2)
    assert {r["page"] for r in got if r["conversation"] == 1} == {0, 1}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out = spark.createDataFrame(out.collect(), out.schema)
            assert 0 < out.count() <= before
            before, docs = out.count(), out
    assert out.select("doc_id").distinct().count() == before


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    prose = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    odd = prose.unionByName(documents(spark, start=90_000)).unionByName(prose.limit(9))
    odd.write.parquet(f"{folder}/documents.parquet")
    ids = [r[0] for r in corpus_pipeline.run(spark, folder).filter("piece = 0").select("doc_id").collect()]
    assert ids and len(ids) == len(set(ids))
    empty(spark).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
