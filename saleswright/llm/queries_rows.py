"""Queries of the operators that work on rows, ids and turns (1, 4, 6, 8, 9, 10)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm import bpe, chat, exact_dedup, packing, sharding, token_store
from saleswright.llm.common import table, text_of
from saleswright.scale import scratch_path

N_SHARDS, SHARD_SEED = 24, 20240607


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    codec = bpe.BpeCodec(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    encoded = codec.encode(table(spark, folder, "documents").select("doc_id", "text"))
    return codec.decode(encoded.select("doc_id", "ids")).select(
        "doc_id",
        bpe.n_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = text_of("text")
    narrow = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    shards = sharding.shard_rows(
        narrow, ["doc_id", "size", "text_crc32"], N_SHARDS, SHARD_SEED
    )
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_token_store(spark: SparkSession, folder: str) -> DataFrame:
    store = scratch_path(spark, "token-store")
    token_store.write_store(
        table(spark, folder, "documents"), store, public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_store.read_store(spark, store).withColumnRenamed("key", "doc_id")


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.copies(table(spark, folder, "documents"))


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM d
WINDOW g AS (PARTITION BY text_sha256)
"""


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    # The ids stay where they are; the packing moves lengths and checksums.
    return packing.pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    rendered = chat.perspectives(table(spark, folder, "conversations"))
    return rendered.select(
        F.col("conversation").alias("conv_id"),
        "speaker",
        "page",
        "n_turns",
        "text",
        F.array_join(
            F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"])), ","
        ).alias("spans"),
        "n_masked",
    )


OP10_SQL = f"""
WITH numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turns ORDER BY turn NULLS FIRST, role, text) AS no
    FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                 coalesce(floor(turn / {chat.PAGE_TURNS}), 0)::BIGINT AS turns
          FROM conversations)
),
shifts AS (
    SELECT conv_id, turns,
           coalesce(sum(more) OVER (PARTITION BY conv_id ORDER BY turns
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift
    FROM (SELECT conv_id, turns, (max(no) - 1) // {chat.PAGE_TURNS} AS more FROM numbered GROUP BY conv_id, turns)
),
said AS (
    SELECT n.conv_id, turn, role, text, (n.turns + shift + (no - 1) // {chat.PAGE_TURNS})::BIGINT AS page
    FROM numbered n JOIN shifts s ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.turns = s.turns
),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
parts AS (
    SELECT s.conv_id, p.speaker, s.page, s.turn, s.role, s.text,
           '{chat.START}' || CASE WHEN s.role = 'system' THEN 'system'
                                  WHEN s.role = p.speaker THEN 'assistant'
                                  ELSE 'user name=' || s.role END || chr(10) AS head,
           s.text || '{chat.END}' AS body,
           s.role = p.speaker AS own
    FROM said s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
),
placed AS (
    SELECT *,
           sum(length(head) + length(body) + 1) OVER w - length(body) - 1 AS body_at
    FROM parts
    WINDOW w AS (PARTITION BY conv_id, speaker, page ORDER BY turn NULLS FIRST, role, text
                 ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, speaker, page, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg(body_at || '-' || (body_at + length(body)), ',' ORDER BY body_at)
                FILTER (WHERE own), '') AS spans,
       coalesce(sum(length(body)) FILTER (WHERE own), 0)::BIGINT AS n_masked
FROM placed
GROUP BY conv_id, speaker, page
"""

ALL = {
    "op1_bpe": (op1_bpe, None),
    "op4_sharding": (op4_sharding, None),
    "op6_token_store": (op6_token_store, None),
    "op8_exact_dedup": (op8_exact_dedup, OP8_SQL),
    "op9_packing": (op9_packing, None),
    "op10_chat": (op10_chat, OP10_SQL),
}
