"""Chat formatting by perspective rotation (operator 10).

A dialogue is rendered once for every participant: that speaker's turns become the
assistant's, everyone else is a user named in the header, and turns of a context role such
as ``system`` stay what they are. The mask lists, in characters of the rendered text, the
spans to learn from: the assistant's words and the end mark after them.

A dialogue is cut into pages of ``page_turns`` turn numbers, by one rule for all lengths, and
each page is a row. ``page`` counts from 0 by turn number; pages without turns have no row.
Turn numbers may repeat or be missing, so a page also holds ``page_turns`` rows at most: what
is more goes on in further pages, and the later pages of the conversation count on from
there. A conversation of any length is so never one task's work. Every participant gets every
page of the conversation.

Null texts are empty. A null role is a participant called ``unknown``. Null turns come first
on page 0. Turns of equal number are ordered by role, then text; repeated rows are all
rendered. Rows with a null conversation are one conversation with a null id. A
conversation that has only context turns has no participant and gives no row. Columns
besides the four are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.llm.common import column, text_of
from saleswright.scale import attach, number_rows, settled

# The marks of the chat template (fixed values).
START, END = "<|im_start|>", "<|im_end|>"
CONTEXT_ROLES = ("system",)
PAGE_TURNS = 64
# Pages that one task counts on from each other, at most.
COUNTED_PAGES = 4096


def header(role: Column, speaker: Column, context_roles: tuple[str, ...]) -> Column:
    """The mark that opens a turn, seen by ``speaker``."""
    label = (
        F.when(role.isin(*context_roles), role)
        .when(role == speaker, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), role))
    )
    return F.concat(F.lit(START), label, F.lit("\n"))


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal values in columns that the right side calls by the name and an underscore."""
    test = F.lit(True)
    for name in names:
        test &= left[name].eqNullSafe(right[name + "_"])
    return test


def bounded(said: DataFrame, page_rows: int) -> DataFrame:
    """Cut pages of more than ``page_rows`` rows, and count the later ones on.

    Only conversations that have such a page are sorted. Their rows are numbered by
    number_rows in the blocks of a sort over the cluster, where equal rows are told apart,
    so that neither a conversation nor a page is gathered.
    """
    at = ["conversation", "page"]
    full = settled(said.groupBy(*at).count().filter(F.col("count") > page_rows))
    if full.isEmpty():
        return said
    # One row of a few words per conversation that has a full page.
    long = full.select(F.col("conversation").alias("conversation_")).distinct()
    met = same(said, long, ["conversation"])
    order = ["turn", "role", "text", "tie"]
    ordered = settled(
        said.join(long, met, "left_semi")
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*at, *order)
        .withColumn("part", F.spark_partition_id().cast("long"))
    )
    numbered = number_rows(
        ordered.withColumn("order", F.struct(*order)), at, "order", "no", block=F.col("part")
    )
    # Pages that were added before a page: those of blocks of pages before, and those inside.
    block = F.floor(F.col("page") / COUNTED_PAGES)
    added = ordered.groupBy(*at).agg((F.ceil(F.count(F.lit(1)) / page_rows) - 1).alias("more"))
    added = added.withColumn("block", block)
    before = (Window.unboundedPreceding, -1)
    blocks = added.groupBy("conversation", "block").agg(F.sum("more").alias("more"))
    over = Window.partitionBy("conversation").orderBy("block").rowsBetween(*before)
    inside = Window.partitionBy("conversation", "block").orderBy("page").rowsBetween(*before)
    blocks = blocks.select(
        F.col("conversation").alias("conversation_"), F.col("block").alias("block_"),
        F.coalesce(F.sum("more").over(over), F.lit(0)).alias("first"),
    )
    starts = added.join(blocks, same(added, blocks, ["conversation", "block"])).select(
        F.col("conversation").alias("conversation_"),
        F.col("page").alias("page_"),
        (F.col("first") + F.coalesce(F.sum("more").over(inside), F.lit(0))).alias("shift"),
    )
    starts = settled(starts)
    cut = F.floor((F.col("no") - 1) / page_rows)
    moved = numbered.join(starts, same(numbered, starts, at)).withColumn(
        "page", (F.col("page") + F.col("shift") + cut).cast("long")
    )
    return said.join(long, met, "left_anti").unionByName(moved.select(*said.columns))


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
    page_turns: int = PAGE_TURNS,
) -> DataFrame:
    """Rows of conversation, speaker, page, n_turns, text, spans and n_masked characters."""
    said = turns.select(
        column(conversation).alias("conversation"),
        column(turn).cast("long").alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit("unknown")).alias("role"),
        text_of(text).alias("text"),
    ).withColumn("page", F.coalesce(F.floor(F.col("turn") / page_turns), F.lit(0)).cast("long"))
    pages = bounded(said, page_turns)
    pages = pages.groupBy("conversation", "page").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    speakers = (
        said.filter(~F.col("role").isin(*context_roles))
        .select("conversation", F.col("role").alias("speaker"))
        .distinct()
    )
    # Null ids must meet: the key is null-safe.
    key = F.struct(F.col("conversation").isNull().alias("none"), F.coalesce(
        F.col("conversation").cast("string"), F.lit("")).alias("id"))
    seen = attach(
        pages.select(key.alias("key"), "conversation", "page", "turns"),
        speakers.select(key.alias("key"), "speaker"),
        ["key"],
    )
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            header(t["role"], F.col("speaker"), context_roles).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            ((t["role"] == F.col("speaker")) & ~t["role"].isin(*context_roles)).alias("own"),
        ),
    )
    rendered = seen.withColumn("parts", parts)
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), no_spans.alias("spans")),
        lambda state, p: F.struct(
            (state["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + 1).alias("at"),
            F.when(
                p["own"],
                F.concat(
                    state["spans"],
                    F.array(
                        F.struct(
                            (state["at"] + F.char_length(p["head"])).alias("start"),
                            (state["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(state["spans"]).alias("spans"),
        ),
    )
    lines = F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n")))
    return rendered.select(
        "conversation",
        "speaker",
        "page",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(lines, "").alias("text"),
        walked["spans"].alias("spans"),
    ).withColumn(
        "n_masked",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]),
    )
