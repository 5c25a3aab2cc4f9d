"""Incentive qualification and earnings of scenario tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.config import DEFAULT_TARGET_PERCENT
from saleswright.functions.cleaning import prefix_number, percent
from saleswright.functions.text import comma_list
from saleswright.scale import attach

KEYS = ["scenario_id", "test_id"]
# Amounts beyond it, which no sale has, count as none.
MONEY = "decimal(28,4)"


def _rate(name: str) -> Column:
    return prefix_number(F.coalesce(F.col(name).cast("string"), F.lit("")))


def scenario_facts(scenarios: DataFrame, frames: DataFrame) -> DataFrame:
    """One row per scenario: SKU lists, rates and its time frames in order.

    The base frame is the last listed frame that is not the current one.
    """
    frame = F.struct(
        "ordinal", "label", F.coalesce("is_current", F.lit(False)).alias("is_current"),
        F.col("start_date").try_cast("date").alias("start_date"),
        F.col("end_date").try_cast("date").alias("end_date"),
    )
    listed = frames.groupBy("scenario_id").agg(
        F.array_sort(F.collect_list(frame)).alias("frames")
    )
    target = _rate("target_percent")
    prior = F.filter("frames", lambda f: ~f["is_current"])
    return scenarios.join(listed, "scenario_id", "left").select(
        "scenario_id",
        "test_type",
        comma_list(F.col("qualifying_skus")).alias("qualifying"),
        comma_list(F.col("earning_skus")).alias("earning"),
        F.when(target == 0, F.lit(DEFAULT_TARGET_PERCENT)).otherwise(target).alias("target"),
        _rate("current_rate").alias("current_rate"),
        _rate("earning_percent").alias("earning_percent"),
        F.coalesce("frames", F.array().cast(_FRAMES)).alias("frames"),
        F.get(F.filter("frames", lambda f: f["is_current"]), F.lit(0)).alias("current"),
        F.element_at(F.when(F.size(prior) > 0, prior), -1).alias("base"),
    )


_FRAMES = (
    "array<struct<ordinal:int,label:string,is_current:boolean,start_date:date,end_date:date>>"
)


def _inside(day: Column, frame: Column) -> Column:
    return F.coalesce(day.between(frame["start_date"], frame["end_date"]), F.lit(False))


def _with_facts(transactions: DataFrame, facts: DataFrame) -> DataFrame:
    rows = attach(transactions, facts, ["scenario_id"])
    text = F.col("total").cast("string")
    return rows.withColumns(
        {
            "_total": prefix_number(F.coalesce(text, F.lit(""))).try_cast(MONEY),
            "_day": F.col("date").try_cast("date"),
            "_q": F.array_contains("qualifying", F.col("sku")),
            "_e": F.array_contains("earning", F.col("sku")),
        }
    )


def _sum(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col("_total"))), F.lit(0)).cast("double")


def _with_tests(transactions: DataFrame, tests: DataFrame | None) -> DataFrame:
    """Add an empty row for every test, which sums to 0 and counts nothing."""
    if tests is None:
        return transactions
    return transactions.unionByName(tests.select(*KEYS), allowMissingColumns=True)


def frame_totals(
    scenarios: DataFrame, frames: DataFrame, transactions: DataFrame, tests: DataFrame | None = None
) -> DataFrame:
    """Qualifying sales per test and time frame, both bounds included; 0 without sales.

    ``tests`` lists all tests; without it, only those that have a transaction are known. A
    row meets only the frames its date falls in.
    """
    transactions = _with_tests(transactions, tests)
    facts = scenario_facts(scenarios, frames)
    rows = _with_facts(transactions, facts)
    hits = F.filter(
        "frames", lambda f: F.col("_q") & _inside(F.col("_day"), f)
    )
    per_frame = (
        rows.select(*KEYS, "_total", F.explode(F.transform(hits, lambda f: f["ordinal"])).alias("ordinal"))
        .groupBy(*KEYS, "ordinal")
        .agg(F.sum("_total").cast("double").alias("total"))
    )
    every = transactions.select(*KEYS).distinct()
    listed = frames.select("scenario_id", "ordinal", "label", "is_current")
    # One scenario may hold many of the tests, so both joins spread them.
    return (
        attach(every, listed, ["scenario_id"])
        .join(per_frame, [*KEYS, "ordinal"], "left")
        .withColumn("total", F.coalesce("total", F.lit(0.0)))
    )


def qualify(
    scenarios: DataFrame, frames: DataFrame, transactions: DataFrame, tests: DataFrame | None = None
) -> DataFrame:
    """One row per test: qualified, earnings, totals and transaction counts.

    ``tests`` lists all tests (scenario_id, test_id), with a transaction or not; without
    it, only those that have one are known.

    yoy: current qualifying sales against the base frame, in percent, must reach
    the target (95 when blank or 0); earnings only when qualified. minQual and
    earningsOnly: always qualified, earnings on all earning sales. Counts ignore dates.
    """
    facts = scenario_facts(scenarios, frames)
    rows = _with_facts(_with_tests(transactions, tests), facts)
    current = _inside(F.col("_day"), F.col("current"))
    base = _inside(F.col("_day"), F.col("base"))
    sums = rows.groupBy(*KEYS).agg(
        _sum(F.col("_q") & current).alias("current_total"),
        _sum(F.col("_q") & base).alias("base_total"),
        _sum(F.col("_e") & current).alias("current_earning"),
        _sum(F.col("_e")).alias("all_earning"),
        F.count_if("_q").alias("q_count"),
        F.count_if("_e").alias("earning_transactions"),
    )
    rules = facts.select("scenario_id", "test_type", "target", "current_rate", "earning_percent")
    yoy = F.col("test_type") == "yoy"
    reached = percent(F.col("current_total"), F.col("base_total"))
    on_all = F.col("all_earning") * F.col("earning_percent") / 100
    on_current = F.col("current_earning") * F.col("current_rate") / 100
    known = F.col("test_type").isin("minQual", "earningsOnly")
    qualified = F.when(yoy, reached >= F.col("target")).otherwise(known)
    return (
        attach(sums, rules, ["scenario_id"])
        .withColumn("qualified", qualified)
        .select(
            *KEYS,
            "test_type",
            "qualified",
            F.when(yoy & F.col("qualified"), on_current)
            .when(known, on_all)
            .otherwise(F.lit(0.0))
            .alias("earnings"),
            F.when(yoy, F.col("current_total")).alias("current_total"),
            F.when(yoy, F.col("base_total")).alias("base_total"),
            F.when(yoy, reached).alias("achieved_percent"),
            F.when(F.col("test_type") == "earningsOnly", F.lit(0))
            .otherwise(F.col("q_count"))
            .cast("long")
            .alias("qualifying_transactions"),
            "earning_transactions",
        )
    )


def qualification_tally(results: DataFrame) -> DataFrame:
    """Qualified and not qualified tests per scenario."""
    return results.groupBy("scenario_id").agg(
        F.count_if("qualified").alias("qualified"),
        F.count_if(~F.col("qualified")).alias("not_qualified"),
    )
