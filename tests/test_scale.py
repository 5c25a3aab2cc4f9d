"""The spreading helpers give the same result whichever way they take."""

import time

import pytest
from pyspark.sql import functions as F

from saleswright import scale
from saleswright.config import BASE_LEDGER
from saleswright.sources import sinks


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def way(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    return request.param


def skewed(spark):
    """One key holds a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("row_idx"))


def test_attach(spark, way, rows):
    big = skewed(spark)
    facts = big.select("key").distinct().withColumn("fact", F.length("key"))
    joined = scale.attach(big, facts, ["key"])
    assert rows(joined.select("row_idx", "fact")) == rows(big.select("row_idx", F.length("key")))
    some = facts.filter("key = 'hot'")
    assert scale.attach(big, some, ["key"], how="left").count() == 3000
    assert scale.attach(big, some, ["key"], how="left_semi").count() == 1000


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_number_rows(spark, way, rows, block):
    big = skewed(spark)
    numbered = scale.number_rows(big, ["key"], "row_idx", "n", block_rows=block)
    from pyspark.sql import Window
    plain = big.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("row_idx")).cast("long"))
    assert rows(numbered.select("key", "row_idx", "n")) == rows(plain)


def test_pages(spark, way):
    sparse = skewed(spark).withColumn("row_idx", F.col("row_idx") * 1_000_003)
    parts = scale.paged(sparse, ["key"], "row_idx", 90)
    sizes = parts.groupBy("key", "part_no").count().collect()
    rows_of = {r["key"]: r["count"] for r in sparse.groupBy("key").count().collect()}
    pages = {}
    for r in sizes:
        pages.setdefault(r["key"], []).append((r["part_no"], r["count"]))
    for key, n in rows_of.items():
        own = sorted(pages[key])
        assert [p for p, _ in own] == list(range(-(-n // 90)))
        assert all(size == 90 for _, size in own[:-1]) and sum(size for _, size in own) == n
    whole = scale.paged(sparse, ["key"], "row_idx", None)
    assert whole.select("part_no").distinct().collect() == [(0,)]


def test_first_examples_limits_before_the_shuffle(spark):
    first = scale.first_examples(skewed(spark), ["key"], ["row_idx"], 5)
    assert first.groupBy("key").count().agg(F.max("count")).first()[0] == 5
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_shared_folder_comes_from_the_session(spark):
    assert scale.scratch_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir())


def test_steps_leave_no_shuffle_files(spark, tmp_path):
    """What a step has shuffled is not needed once its rows are stored."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {blocks.apply(i).name() for i in range(blocks.size())
                if blocks.apply(i).name().startswith("shuffle_")}

    def left(before):
        until = time.time() + 20
        while (more := shuffles() - before) and time.time() < until:
            time.sleep(0.2)
        return more

    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("transaction_id"))
    rows = rows.groupBy("transaction_id").count().drop("count")
    rows = rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "transaction_id" else "transaction_id" for f in BASE_LEDGER.schema.fields])
    before = shuffles()
    scale.settled(rows)
    sinks.append_ledger_files(rows, str(tmp_path / "ledger"), BASE_LEDGER)
    assert not left(before)
    assert sinks.read_ledger_files(spark, str(tmp_path / "ledger"), BASE_LEDGER).count() == 7
