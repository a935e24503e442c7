"""Multi-party chat: every participant's view of a dialogue.

For every participant the dialogue is rendered with that speaker as the assistant, all other speakers as named users, and
system turns as system; the spans that bear loss are the assistant's turns with their end mark. A dialogue is rendered in
parts of consecutive turns, in order of ``(first_turn, slice)``; joined, the parts are the whole rendering. Parts are bounded:
``part_turns`` turn numbers, or, where more than ``part_rows`` rows share such a range, one turn number and a range of the
row's hash. So a conversation that holds a third of all rows is spread over many tasks, its text is shuffled once, and the
participants are joined to parts, not to turns. Everything is DataFrame functions.

Defined results: rows that are equal in all columns used count once; rows of one turn are ordered by a hash of role and text;
a null text is empty; a row with a null role is an unnamed user and nobody's view; a null turn comes first; a null
conversation id is a conversation of its own; a dialogue without participants gives no row; ``<|`` in names and texts is
written ``<\\|`` so that no text forges a mark; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART_TURNS = 64
PART_ROWS = 256
SYSTEM = "system"
END = "<|end|>\n"


def _plain(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 part_turns: int = PART_TURNS, part_rows: int = PART_ROWS) -> DataFrame:
    """``conv``, ``participant``, ``first_turn``, ``slice``, ``turns``, ``rendered`` and ``loss_spans`` ("start-end,…" in
    characters of ``rendered``, end exclusive)."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"),
                        F.col(text_col).cast("string").alias("text")).distinct()
    speakers = (rows.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select("conv", F.col("role").alias("participant")).distinct())
    base = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-(1 << 60)))
    rows = rows.withColumns({"range": base, "h": F.xxhash64("role", "text")})
    sizes = rows.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows).withColumnsRenamed({"conv": "_conv", "range": "_range"})
    share = (F.shiftrightunsigned("h", 33) / float(1 << 31))
    rows = (rows.join(sizes, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("range") == F.col("_range")), "left")
            .withColumn("one", F.when(F.col("n").isNotNull(), F.coalesce("turn", F.lit(-1))))
            .withColumn("slice", F.coalesce(F.floor(share * F.ceil(F.col("n") / part_rows)), F.lit(0)).cast("int")))
    order = F.struct("turn", F.shiftrightunsigned("h", 33).alias("high"), "h", "role", "text")
    parts = rows.groupBy("conv", "range", "one", "slice").agg(F.array_sort(F.collect_list(order)).alias("said"), F.min("turn").alias("first_turn"))
    seen = parts.join(speakers.withColumnRenamed("conv", "_of"), F.col("conv").eqNullSafe(F.col("_of")))
    me = F.col("participant")

    def head(t: Column) -> Column:
        return (F.when(t.role == SYSTEM, F.lit("<|system|>\n")).when(t.role == me, F.lit("<|assistant|>\n"))
                .when(t.role.isNull(), F.lit("<|user|>\n")).otherwise(F.concat(F.lit("<|user:"), _plain(t.role), F.lit("|>\n"))))

    segments = F.transform("said", lambda t: F.struct(head(t).alias("head"), F.concat(_plain(t.text), F.lit(END)).alias("body"),
                                                      F.coalesce((t.role == me) & (t.role != SYSTEM), F.lit(False)).alias("own")))
    seen = seen.withColumn("segments", segments)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def walk(a: Column, s: Column) -> Column:
        body = a.at + F.char_length(s.head)
        end = body + F.char_length(s.body)
        return F.struct(end.alias("at"), F.when(s.own, F.array_append(a.spans, F.concat_ws("-", body.cast("string"), end.cast("string")))).otherwise(a.spans).alias("spans"))

    return seen.select(
        "conv", "participant", "first_turn", "slice", F.size("said").alias("turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s.head, s.body)), "").alias("rendered"),
        F.array_join(F.aggregate("segments", start, walk, lambda a: a.spans), ",").alias("loss_spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every participant's view of every conversation."""
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet")).withColumnRenamed("conv", "conv_id")


SQL = f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS participant FROM rows WHERE role <> '{SYSTEM}'),
segments AS (
  SELECT r.conv_id, s.participant, r.turn, r.turn // {PART_TURNS} AS range, r.role = s.participant AS own,
    CASE WHEN r.role = '{SYSTEM}' THEN '<|system|>' WHEN r.role = s.participant THEN '<|assistant|>'
         ELSE '<|user:' || replace(r.role, '<|', '<\\|') || '|>' END || chr(10) AS head,
    replace(coalesce(r.text, ''), '<|', '<\\|') || '<|end|>' || chr(10) AS body
  FROM rows r JOIN speakers s ON r.conv_id = s.conv_id),
placed AS (
  SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, participant, range ORDER BY turn) AS BIGINT) AS upto FROM segments)
SELECT conv_id, participant, min(turn) AS first_turn, CAST(0 AS INTEGER) AS slice, CAST(count(*) AS INTEGER) AS turns,
  string_agg(head || body, '' ORDER BY turn) AS rendered,
  coalesce(string_agg(CASE WHEN own THEN (upto - length(body)) || '-' || upto END, ',' ORDER BY turn), '') AS loss_spans
FROM placed GROUP BY conv_id, participant, range
"""
