"""Chat formatting by perspective: each participant in turn is the assistant of the dialogue.

For every speaker of a conversation the whole dialogue is rendered once, with that
speaker's turns as ``assistant``, all other speakers as named users and system turns as
they are. The mask of a rendering holds the character ranges of the speaker's own turns,
texts and end marks, which are the ones to learn from.

A rendering comes in blocks of ``BLOCK_TURNS`` turn numbers, so that no row grows with the
dialogue; texts of blocks join by plain concatenation and ``text_start`` is the place of a
block in the whole. Everything is DataFrame operations.

Defined results: rows without conv_id belong to no dialogue and are left out. A null role is
an unnamed user who is never rendered as assistant; a dialogue without speakers gives no
rows. A null text is empty; a null turn comes before all others. Rows of equal turn are ordered
by role and text; repeated rows are rendered each. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 64
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _segments(turns: Column, speaker: Column) -> Column:
    """Head and body of each turn, and whether it is the speaker's."""

    def one(turn: Column) -> Column:
        role = turn["role"]
        own = F.coalesce(role == speaker, F.lit(False))
        name = (
            F.when(own, "assistant")
            .when(role == SYSTEM, SYSTEM)
            .when(role.isNull(), "user")
            .otherwise(F.concat(F.lit("user name="), role))
        )
        head = F.concat(F.lit(OPEN), name, F.lit("\n"))
        return F.struct(head.alias("head"), F.concat(turn["text"], F.lit(CLOSE + "\n")).alias("body"), own.alias("own"))

    return F.transform(turns, one)


def perspectives(conversations: DataFrame) -> DataFrame:
    """conv_id, speaker, block, text_start, text, n_turns, mask (array of start and end in the block's text)."""
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS).alias("block"),
        F.coalesce("turn", F.lit(-1)).alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    speakers = turns.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("speaker")).distinct()
    blocks = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # Lengths follow from narrow rows, so no rendered text is moved: a block is rendered where it was gathered.
    starts = _starts(turns, speakers)
    rendered = blocks.join(starts, ["conv_id", "block"]).select(
        "conv_id", "speaker", "block", "text_start", _segments(F.col("turns"), F.col("speaker")).alias("s")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        span = F.array(F.struct(begin.alias("start"), (end - 1).alias("end")))
        return F.struct(end.alias("at"), F.when(x["own"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask"))

    text = F.array_join(F.transform("s", lambda x: F.concat(x["head"], x["body"])), "")
    return rendered.select(
        "conv_id", "speaker", "block", "text_start", text.alias("text"), F.size("s").alias("n_turns"), F.aggregate("s", start, step)["mask"].alias("mask")
    )


def _starts(turns: DataFrame, speakers: DataFrame) -> DataFrame:
    """conv_id, speaker, block, text_start: where each block of a rendering begins."""
    role = F.col("role")
    name = F.when(role == SYSTEM, len(SYSTEM)).when(role.isNull(), len("user")).otherwise(len("user name=") + F.length(role))
    held = turns.groupBy("conv_id", "block", "role").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    frame = len(OPEN) + len("\n") + len(CLOSE) + len("\n")
    as_others = held.groupBy("conv_id", "block").agg(F.sum(F.col("chars") + F.col("n") * (name + frame)).alias("size"))
    own = held.filter(role.isNotNull()).select("conv_id", "block", role.alias("speaker"), F.col("n").alias("own"))
    less = F.coalesce("own", F.lit(0)) * (len("user name=") + F.length("speaker") - len("assistant"))
    sizes = as_others.join(speakers, "conv_id").join(own, ["conv_id", "block", "speaker"], "left")
    before = Window.partitionBy("conv_id", "speaker").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "conv_id", "speaker", "block", F.coalesce(F.sum(F.col("size") - less).over(before), F.lit(0)).cast("bigint").alias("text_start")
    )


def op10_perspectives(spark, sf_dir: str) -> DataFrame:
    made = perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit(":"), m["end"].cast("string"))), " ")
    return made.select("conv_id", "speaker", "block", "text_start", "text", "n_turns", spans.alias("mask"))


OP10_SQL = """
WITH turns AS (
  SELECT conv_id, CAST(floor(coalesce(turn, -1) / 64.0) AS BIGINT) AS block, coalesce(turn, -1) AS turn, role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'),
pieces AS (
  SELECT t.conv_id, s.speaker, t.block, t.turn, t.role, t.text, coalesce(t.role = s.speaker, false) AS own,
    '<|im_start|>' || CASE WHEN t.role = s.speaker THEN 'assistant' WHEN t.role = 'system' THEN 'system'
      WHEN t.role IS NULL THEN 'user' ELSE 'user name=' || t.role END || chr(10) AS head,
    t.text || '<|im_end|>' || chr(10) AS body
  FROM turns t JOIN speakers s ON t.conv_id = s.conv_id),
placed AS (
  SELECT *, row_number() OVER w AS k, sum(length(head) + length(body)) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM pieces WINDOW w AS (PARTITION BY conv_id, speaker, block ORDER BY turn, role NULLS FIRST, text)),
blocks AS (
  SELECT conv_id, speaker, block, string_agg(head || body, '' ORDER BY k) AS text, count(*) AS n_turns,
    coalesce(string_agg((upto - length(body))::BIGINT || ':' || (upto - 1)::BIGINT, ' ' ORDER BY k) FILTER (own), '') AS mask
  FROM placed GROUP BY ALL)
SELECT conv_id, speaker, block,
  CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, speaker ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS text_start,
  text, CAST(n_turns AS INTEGER) AS n_turns, mask
FROM blocks
"""
