"""Versions, ranks and top-N lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloom.operators.staging import stage


def newest(*columns: str) -> list[Column]:
    """Descending order with NULL last, which Spark and other engines do not agree on by default."""
    return [F.desc_nulls_last(c) for c in columns]


def ranked(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Add ``rank()``. Without keys the whole frame is one window, so pass a deduplicated list.

    A later ``rank <= n`` becomes a WindowGroupLimit, which cuts every input partition before the
    exchange.
    """
    spec = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return df.withColumn(name, F.rank().over(spec))


def ranked_globally(df: DataFrame, order: Mapping[str, bool], name: str = "rank") -> DataFrame:
    """``rank()`` over the whole frame without gathering it: ``order`` maps columns to "descending"; NULL is last.

    Ranks depend on the sort keys only, so equal keys are counted first, however many rows share one. The distinct keys are dealt to ranges; each range
    numbers its keys by a window of its own, the totals of the ranges before it (one number a range) are added, and
    the rows find their key's rank by a join.
    """
    keys = list(order)
    by = [F.desc_nulls_last(k) if falling else F.asc_nulls_last(k) for k, falling in order.items()]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    dealt = stage(counted.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "sort-keys")
    starts, total = [], 0
    for r in dealt.groupBy("_range").agg(F.sum("_n").alias("n")).orderBy("_range").collect():
        starts += [F.lit(r["_range"]), F.lit(total).cast("long")]
        total += r["n"]
    if not starts:
        return df.withColumn(name, F.lit(None).cast("int"))
    before = F.sum("_n").over(Window.partitionBy("_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))
    rank = (1 + F.element_at(F.create_map(*starts), F.col("_range")) + F.coalesce(before, F.lit(0))).cast("int")
    listed = dealt.select(*[F.col(k).alias(f"_{k}") for k in keys], rank.alias(name))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(listed, same).drop(*[f"_{k}" for k in keys])


def top_ranked(df: DataFrame, n: int, order: Sequence[Column], keys: Sequence[str] = (),
               name: str = "rank") -> DataFrame:
    """Rows of rank 1..n; ties share a rank, so more than n rows may be returned."""
    return ranked(df, order, keys, name).filter(F.col(name) <= n)


def latest_versions(df: DataFrame, keys: Sequence[str], created: str) -> DataFrame:
    """The newest version of each key (all of them on a tie)."""
    return top_ranked(df.distinct(), 1, newest(created), keys, "_version").drop("_version")


def newest_rows(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Exactly n rows; end ``columns`` with an id so that the cut is repeatable."""
    return df.orderBy(*newest(*columns)).limit(n)


def latest_id_per(df: DataFrame, by: str | Sequence[str], identifier: str) -> DataFrame:
    """Largest id of each date; text ids compare as text.

    The maximum of a text cannot be kept in a hash aggregate's buffer, so Spark would sort the whole fact
    by date. Text ids are therefore deduplicated first, which leaves a short list to sort.
    """
    keys = [by] if isinstance(by, str) else list(by)
    listed = df.select(*keys, identifier)
    if listed.schema[identifier].dataType.simpleString() == "string":
        listed = listed.distinct()
    return listed.groupBy(*keys).agg(F.max(identifier).alias(identifier))


def only_value(df: DataFrame, column: str) -> Column:
    """The one value of a pointer table as a scalar subquery: NULL if empty, an error if several rows."""
    return df.select(column).scalar()


def largest(df: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery (NULL for an empty frame)."""
    return df.agg(F.max(column)).scalar()


def portfolio_list(forecasts: DataFrame, n: int, status: str | None = None,
                   since: str | None = None, latest_only: bool = False,
                   tiebreak: bool = True) -> DataFrame:
    """Ids of the n newest portfolios that occur in a forecast fact."""
    rows = forecasts
    if status is not None:
        rows = rows.filter(F.col("portfolio_status") == status)
    if since is not None:
        rows = rows.filter(F.col("dataset_date") >= F.lit(since).cast("date"))
    if latest_only:
        rows = rows.filter(F.col("is_latest_publish") == "Y")
    listed = rows.select("portfolio_id", "dataset_date").distinct()
    order = newest("dataset_date", "portfolio_id") if tiebreak else newest("dataset_date")
    return top_ranked(listed, n, order).select("portfolio_id")


#: Ids of a list up to this number are put into the scan of the fact as literals.
PUSHED_IDS = 200


def with_ids(rows: DataFrame, ids: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to a short staged list on ``columns``; the first of them also filters the scan of ``rows``.

    At most ``PUSHED_IDS + 1`` of its values come to the driver. Up to ``PUSHED_IDS`` they become an IN list, which Parquet tests against the bounds and
    Bloom filters of row groups, so that of a fact clustered by id only the row groups of these ids are read. The join decides
    in every case; a longer list is only joined.
    """
    first = F.col(columns[0])
    values = [r[0] for r in ids.select(first).where(first.isNotNull()).distinct().limit(PUSHED_IDS + 1).collect()]
    if len(values) <= PUSHED_IDS:
        rows = rows.filter(first.isin(*values) if values else F.lit(False))
    return rows.join(ids, list(columns), how)


def recent_portfolios(pins: DataFrame, *lists: DataFrame) -> DataFrame:
    """Pinned portfolios and the given lists, each id once."""
    ids = pins.select("portfolio_id")
    for other in lists:
        ids = ids.union(other)
    return ids.distinct()
