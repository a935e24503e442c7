"""K-d tree sharding: weighted medians along the widest metadata dimension until the leaves reach the target bytes.

Only ids, sizes and coordinates of the rows are read after the first pass, from a table in the shared folder. Every
dimension is scaled to 12 bits over its global range (strings by their first bytes); 32 bits of a hash of the row's
number break ties, so that a value held by a third of all rows can be split like any other. Per level of the tree and
for all its nodes together: one aggregation gives each node's range in every dimension, the widest is taken, and the
cut that gives both sides their share of the bytes is found by a radix search over histograms of at most 8192 bins a node
(weights summed map-side). A level's nodes are a table in the shared folder that the rows join, broadcast only while the
planner knows it to be small, so the number of leaves has no bound on the driver. A node that stands for ``k`` leaves is
cut ``k // 2 : k - k // 2``, so any number of leaves gets near-equal bytes.

Rows get gapless places in their leaf from counts of small hash buckets and numbers within a bucket; no leaf is sorted as a
whole. Everything is DataFrame functions.

Defined results: a null text has no bytes and the checksum of the empty text; a null dimension value is the smallest; a null
id stays null; repeated rows are separate rows; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyloom.operators.staging import stage

OVERHEAD = 16
COORDINATE_BITS = 12
TIE_BITS = 32
DIGIT_BITS = 13
#: Share of a leaf's bytes by which a cut may miss the median.
TOLERANCE = 1e-3
ROWS_PER_BUCKET = 100_000


def _number(docs: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(docs.schema[name].dataType, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))
    return c.cast("double")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text",
          dimensions: tuple[str, ...] = ("source", "lang", "n_chars")) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` (0 to shards - 1) and ``slot`` of every row.

    Give the number of leaves, or ``target_bytes`` for the smallest number whose leaves hold at most that on average.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [f"x{i}" for i in range(len(dimensions))]
    rows = stage(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[_number(docs, d).alias(n) for d, n in zip(dimensions, names)], F.monotonically_increasing_id().alias("uid"), F.lit(0).alias("first")), "shard-rows")
    spans = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
                     *[f(F.nanvl(n, F.lit(None))).alias(f"{n}_{k}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
    total = spans["bytes"] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    top = (1 << COORDINATE_BITS) - 1
    tie = F.shiftrightunsigned(F.xxhash64("uid"), 64 - TIE_BITS)

    def key(n: str) -> Column:
        lo, hi = spans[f"{n}_lo"], spans[f"{n}_hi"]
        if lo is None or hi <= lo:
            return tie
        at = F.floor((F.coalesce(F.nanvl(n, F.lit(lo)), F.lit(lo)) - F.lit(lo)) / F.lit(hi - lo) * top)
        return F.shiftleft(at.cast("long"), TIE_BITS).bitwiseOR(tie)

    keyed = rows.select("id", "size", "text_crc32", "uid", "first", tie.alias("tie"), F.array(*[key(n) for n in names] or [tie]).alias("keys"))
    rows = _grow(keyed, len(names) or 1, shards, total / shards)
    placed = rows.select("id", "size", "text_crc32", "uid", "tie", F.col("first").alias("shard"))
    buckets = max(1, -(-spans["n"] // (ROWS_PER_BUCKET * shards)))
    placed = placed.withColumn("bucket", (F.col("tie") % buckets).cast("int"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select("shard", "bucket", before.alias("before"))
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("uid")).cast("long") - 1
    return (placed.withColumn("within", within).join(counts, ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int"), (F.col("before") + F.col("within")).alias("slot")))


def _grow(keyed: DataFrame, dims: int, shards: int, leaf_bytes: float) -> DataFrame:
    """``keyed`` with ``first``, the first leaf below the node of a row, narrowed to its own leaf; written once a level."""
    rows = keyed.withColumn("leaves", F.lit(shards))
    half, right = F.expr("CAST(leaves DIV 2 AS INT)"), F.expr("keys[dim] >= cut")
    for _ in range((shards - 1).bit_length()):
        at = rows.join(_cuts(rows, dims, leaf_bytes).select("first", "dim", "cut"), "first", "left")
        rows = stage(at.select(*[c for c in keyed.columns if c != "first"], F.when(right, F.col("first") + half).otherwise(F.col("first")).alias("first"),
                               F.when(right, F.col("leaves") - half).when(~right, half).otherwise(F.col("leaves")).alias("leaves")), "shard-level")
    return rows


def _cuts(rows: DataFrame, dims: int, leaf_bytes: float) -> DataFrame:
    """Every node of ``rows`` that has more than one leaf: its dimension ``dim`` and the key ``cut`` below which its goal of bytes lies."""
    coordinate = [F.shiftright(F.col("keys")[d], TIE_BITS) for d in range(dims)]
    ranges = rows.where("leaves > 1").groupBy("first", "leaves").agg(
        F.sum("size").cast("double").alias("bytes"), F.array(*[F.max(c) - F.min(c) for c in coordinate]).alias("widths"))
    nodes = stage(ranges.select(
        "first", (F.array_position("widths", F.array_max("widths")) - 1).cast("int").alias("dim"), F.expr("bytes * (leaves DIV 2) / leaves").alias("goal"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("below"), F.lit(None).cast("long").alias("cut")), "shard-nodes")
    shift = COORDINATE_BITS + TIE_BITS
    while shift and not nodes.where("cut IS NULL").isEmpty():
        step = min(DIGIT_BITS, shift)
        shift -= step
        open_nodes = nodes.where("cut IS NULL")
        digits = (rows.join(open_nodes.select("first", "dim", "prefix"), "first").select("first", "size", "prefix", F.expr("keys[dim]").alias("key"))
                  .where(F.shiftright("key", shift + step) == F.col("prefix")))
        bins = digits.groupBy("first", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("bytes"))
        bins = bins.withColumn("upto", F.sum("bytes").over(W.partitionBy("first").orderBy("bin")))
        crossing = (bins.join(open_nodes.select("first", "goal", "below"), "first").where("upto + below >= goal").groupBy("first")
                    .agg(F.min_by(F.struct("bin", "bytes", (F.col("upto") + F.col("below")).alias("upto")), "bin").alias("c")))
        near = F.lit(True) if shift == 0 else F.col("c.bytes") <= F.lit(TOLERANCE * leaf_bytes)
        nearer_above = F.expr("CAST(c.upto - goal < goal - (c.upto - c.bytes) AS BIGINT)")
        nodes = stage(nodes.join(crossing, "first", "left").select(
            "first", "dim", "goal", F.coalesce("c.bin", "prefix").alias("prefix"), F.coalesce(F.expr("c.upto - c.bytes"), "below").alias("below"),
            F.coalesce("cut", F.when(near, F.shiftleft(F.col("c.bin") + nearer_above, shift))).alias("cut")), "shard-nodes")
    return nodes


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all documents in 40 shards of near-equal bytes."""
    placed = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
