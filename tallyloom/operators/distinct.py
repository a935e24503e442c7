"""Distinct counts by bitmaps over dense codes: one aggregation for several columns, mergeable partials, no repeated rows.

Each column gets a dense code: numbers and dates their distance from the smallest, texts their place in the staged list of their values. A bucket
holds ``BITS`` codes, one bit each (Spark's bitmap functions). Rows are grouped by the keys and the buckets, usually one a column, and each group keeps one bitmap
a column. Bitmaps of equal buckets are united by OR, so partials of days or files merge into the counts of all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloom.operators.staging import stage

BITS = 32_768


def dense_texts(rows: DataFrame, column: str) -> DataFrame:
    """``(column, code)`` of the distinct values of a text column, as a staged list."""
    values = stage(rows.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_part", F.spark_partition_id()), "values")
    sizes = {r["_part"]: r["n"] for r in values.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one number a partition
    before, starts = 0, []
    for part in sorted(sizes):
        starts += [F.lit(part), F.lit(before).cast("long")]
        before += sizes[part]
    start = F.element_at(F.create_map(*starts), F.col("_part")) if starts else F.lit(0).cast("long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return stage(values.select(column, (start + place).alias("code")), "codes")


def partial_bitmaps(rows: DataFrame, keys: Sequence[str], codes: Mapping[str, Column]) -> DataFrame:
    """Bitmaps of ``rows``: the keys, and ``<name>_bucket`` and ``<name>_bits`` of each code column. A null code sets no bit."""
    buckets = {f"{n}_bucket": F.floor(F.coalesce(c, F.lit(0)) / BITS).cast("long") for n, c in codes.items()}
    # Spark's bit positions count from 0 within a bucket of its own; a code is moved to its bucket first. NULL sets no bit
    bits = [F.bitmap_construct_agg(F.pmod(c, F.lit(BITS)).cast("long")).alias(f"{n}_bits") for n, c in codes.items()]
    return rows.withColumns(buckets).groupBy(*keys, *buckets).agg(*bits)


def counts_of(partials: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts per key of (the union of) partial bitmaps."""
    out = None
    for n in names:
        united = partials.groupBy(*keys, f"{n}_bucket").agg(F.bitmap_or_agg(f"{n}_bits").alias("_bits"))
        counted = united.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(n))
        if out is None:
            out = counted
        else:
            same = [out[k].eqNullSafe(counted[k]) for k in keys]
            condition = same[0]
            for s in same[1:]:
                condition = condition & s
            out = out.join(counted, condition).select(*[out[c] for c in out.columns], counted[n])
    return out
