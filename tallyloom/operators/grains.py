"""Aggregation over several date grains, and final/system forecasts, in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar


def multi_grain(df: DataFrame, day: str, keys: Sequence[str], sums: Mapping[str, Column],
                distinct_days: str | None = None, grains: Sequence[str] = calendar.GRAINS) -> DataFrame:
    """Sums (and the number of distinct days) per key and period, long form.

    Done in two steps. A cell is the part of a planning week inside one month; it lies in exactly one
    period of each grain, so the facts are first aggregated to cells (one scan, one exchange), and only
    the cells are repeated per grain. The distinct days of a cell are kept as a 7-bit mask of weekdays;
    cells of one period are disjoint in days, so counts add up.
    """
    d = F.col(day)
    cells = df.withColumn("_week", calendar.week_start(d)).withColumn("_month", F.trunc(d, "month"))
    parts = [F.sum(c).alias(n) for n, c in sums.items()]
    if distinct_days:
        weekday_bit = F.call_function("shiftleft", F.lit(1), F.dayofweek(d))
        parts.append(F.bit_or(weekday_bit).alias("_days"))
    return _rolled(cells.groupBy(*keys, "_week", "_month").agg(*parts), keys, list(sums), distinct_days, grains)


def roll_cells(cells: DataFrame, day: str, keys: Sequence[str], sums: Sequence[str], grains: Sequence[str] = calendar.GRAINS) -> DataFrame:
    """The second step of :func:`multi_grain` alone, for rows that are sums of cells, each named by one of its days.

    Cells are dealt by their keys before they are repeated per grain, which serves the aggregation: cells are exchanged, not
    their copies. A key has as many cells as the calendar at most (from each source), so a frequent one is no hot group.
    """
    named = cells.withColumn("_week", calendar.week_start(F.col(day))).withColumn("_month", F.trunc(day, "month"))
    return _rolled(named.drop(day).repartition(*keys), keys, sums, None, grains)


def _rolled(cells: DataFrame, keys: Sequence[str], sums: Sequence[str], distinct_days: str | None, grains: Sequence[str]) -> DataFrame:
    starts = {"Weekly": F.col("_week"), "Monthly": F.col("_month"),
              "Quarterly": F.trunc("_month", "quarter"), "Yearly": F.trunc("_month", "year")}
    periods = F.array(*[F.struct(F.lit(g).alias("grain"), starts[g].alias("start")) for g in grains])
    out = [F.sum(n).alias(n) for n in sums]
    if distinct_days:
        out.append(F.sum(F.bit_count("_days")).alias(distinct_days))
    return (cells.withColumn("_p", F.explode(periods))
            .groupBy(F.col("_p.grain").alias("date_granularity"), *keys, F.col("_p.start").alias("target_day"))
            .agg(*out))


def final_and_system(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column],
                     system: Column, names: tuple[str, str] = ("Final", "System"),
                     tag: str = "initiative") -> DataFrame:
    """Final rows (everything) and system rows (where ``system`` holds) from one aggregation.

    Each group is summed twice side by side and then split into its two output rows, so the fact is
    scanned and exchanged once. A group without system rows gives no system row.
    """
    sums = []
    for n, m in measures.items():
        sums += [F.sum(m).alias(f"_f_{n}"), F.sum(F.when(system, m)).alias(f"_s_{n}")]
    grouped = df.groupBy(*keys).agg(*sums, F.count_if(system).alias("_hits"))

    def side(name: str, prefix: str) -> Column:
        return F.struct(F.lit(name).alias("tag"), *[F.col(f"{prefix}{n}").alias(n) for n in measures])

    final, extra = side(names[0], "_f_"), side(names[1], "_s_")
    rows = F.when(F.col("_hits") > 0, F.array(final, extra)).otherwise(F.array(final))
    split = grouped.withColumn("_row", F.explode(rows))
    return split.select(*keys, F.col("_row.tag").alias(tag), *[F.col(f"_row.{n}").alias(n) for n in measures])
