"""A set of logical tables, each a DataFrame made on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.staging import current_run, stage
from tallyloom.sources.schemas import CLUSTERED_BY, DAY_OF, SCHEMAS, VERSION_OF


MONTH = "month"  # folder column of a stored fact
VERSIONS = "versions"  # folder of the stored version lists
#: Rows of a staged table that one task reads, about, where every core has a task.
ROWS_PER_TASK = 4_000_000
Bound = str | dt.date | Column | None


def _in_large_tasks(staged: DataFrame) -> DataFrame:
    """A staged table read in one task a core, or one per :data:`ROWS_PER_TASK` if those are more (fewer if the scan has fewer).

    Each task that sums a fact hands on up to all groups of its days, so that many small ones move the same groups again and again.
    """
    cores = staged.sparkSession.sparkContext.defaultParallelism
    return staged.coalesce(max(cores, staged.count() // ROWS_PER_TASK))


def _bound(value: Bound) -> Column | None:
    if value is None or isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


class Tables(Mapping):
    """``tables["orders_actuals"]`` -> DataFrame. Makers receive the set itself.

    A maker may keep the folder column of a stored fact; it is not part of the logical table, but
    :meth:`days` uses it.
    """

    def __init__(self, spark: SparkSession, makers: Mapping[str, Callable[["Tables"], DataFrame]]):
        self.spark = spark
        self._makers = dict(makers)
        self._frames: dict[str, DataFrame] = {}

    def _frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._makers[name](self)
        return self._frames[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._frame(name).drop(MONTH) if name in DAY_OF else self._frame(name)

    def days(self, name: str, *ranges: tuple[Bound, Bound]) -> DataFrame:
        """Rows of a fact whose day lies in one of the closed ranges (None: open end).

        For a stored fact the same test is put on the month folder, so other months are not listed.
        """
        df = self._frame(name)
        day, month = F.col(DAY_OF[name]), F.col(MONTH)
        parts = []
        for first, last in ((_bound(a), _bound(b)) for a, b in ranges):
            part = F.lit(True)
            if first is not None:
                part = part & (day >= first)
                if MONTH in df.columns:
                    part = part & (month >= F.trunc(first, "month"))
            if last is not None:
                part = part & (day <= last)
                if MONTH in df.columns:
                    part = part & (month <= F.trunc(last, "month"))
            parts.append(part)
        while len(parts) > 1:  # a balanced tree, however many ranges there are
            parts = [functools.reduce(Column.__or__, parts[i:i + 2]) for i in range(0, len(parts), 2)]
        return df.filter(parts[0] if parts else F.lit(False)).drop(MONTH)

    def versions(self, name: str) -> DataFrame:
        """Distinct :data:`VERSION_OF` rows of a fact: read from the lists stored beside it, else by one pass over the fact.

        Reports take their ranks, newest ids and last days from this list, so the fact is not read once per list.
        """
        listed = f"{VERSIONS}/{name}"
        if listed in self._makers:
            return self._frame(listed)
        at = f"{listed} in {current_run()}"  # a list staged in a run scope goes with it
        if at not in self._frames:
            self._frames[at] = stage(self[name].select(*VERSION_OF[name]).distinct(), VERSIONS)
        return self._frames[at]

    def __iter__(self) -> Iterator[str]:
        return (k for k in self._makers if not k.startswith(VERSIONS))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def staged(self, *names: str) -> "Tables":
        """The same set, where the named tables (if it has them) are staged on first use.

        For tables that others are made from, each time by the same joins: however often a report reads those, the joins run once. They are read
        in large tasks, which sum more of their rows before an exchange.
        """
        def once(make: Callable[["Tables"], DataFrame], name: str) -> Callable[["Tables"], DataFrame]:
            return lambda t: _in_large_tasks(stage(make(t), name))
        return Tables(self.spark, self._makers | {n: once(self._makers[n], n) for n in names if n in self._makers})

    def replaced(self, **frames: DataFrame) -> "Tables":
        """The same set with some tables given as frames."""
        kept = {k: m for k, m in self._makers.items() if k.removeprefix(f"{VERSIONS}/") not in frames}
        return Tables(self.spark, kept | {k: (lambda _, d=d: d) for k, d in frames.items()})


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> Tables:
    """Tables or views of the session catalog, ``{"orders_actuals": "warehouse.order_actuals"}``."""
    return Tables(spark, {k: (lambda t, n=n: t.spark.table(n)) for k, n in names.items()})


def stored_tables(spark: SparkSession, root: str) -> Tables:
    """Parquet folders written by :func:`store`; explicit schemas, so no file is opened to infer one."""
    def reader(name: str) -> Callable[[Tables], DataFrame]:
        if name not in DAY_OF:
            return lambda t: t.spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
        return lambda t: t.spark.read.schema(f"{SCHEMAS[name]}, {MONTH} date").parquet(f"{root}/{name}")

    def lister(name: str) -> Callable[[Tables], DataFrame]:
        types = {c.name: c for c in StructType.fromDDL(SCHEMAS[name])}
        schema = StructType([*(types[c] for c in VERSION_OF[name]), StructType.fromDDL(f"{MONTH} date")[0]])
        return lambda t: t.spark.read.schema(schema).parquet(f"{root}/{VERSIONS}/{name}").select(*VERSION_OF[name]).distinct()
    return Tables(spark, {n: reader(n) for n in SCHEMAS} | {f"{VERSIONS}/{n}": lister(n) for n in VERSION_OF})


def _trimmed(df: DataFrame) -> DataFrame:
    """Codes without blanks around them: blank-padded codes would not compare equal later on."""
    return df.withColumns({f.name: F.trim(f.name) for f in df.schema.fields if f.dataType.simpleString() == "string"})


def _write_months(df: DataFrame, root: str, name: str, months: int, files_per_month: int, mode: str) -> None:
    """Write the rows of a fact into month folders and the versions of each month into a folder of the same name.

    Rows are dealt to files by ranges of month, ids (:data:`CLUSTERED_BY`) and a hash of the row, and sorted by them: an id lies in one file
    of a month, or in neighbouring ones if it is large, and its row groups are told apart by their bounds and Bloom filters. A busy month, country or
    id is split by the hash, which unlike a random salt is the same when a lost task is run again.
    """
    ids = CLUSTERED_BY.get(name, ())
    keys = [F.col(c) for c in (MONTH, *ids)]
    rows = df.withColumn(MONTH, F.trunc(DAY_OF[name], "month"))
    dealt = rows.repartitionByRange(max(1, months * files_per_month), *keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(MONTH)
    for c in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", "1000")
    writer.parquet(f"{root}/{name}")


def _write_versions(spark: SparkSession, root: str, name: str, mode: str, months: Sequence[dt.date] | None = None) -> None:
    written = spark.read.schema(f"{SCHEMAS[name]}, {MONTH} date").parquet(f"{root}/{name}")
    if months is not None:
        written = written.where(F.col(MONTH).isin(*months))
    (written.select(*VERSION_OF[name], MONTH).distinct().repartition(MONTH)
     .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(MONTH).parquet(f"{root}/{VERSIONS}/{name}"))


def _months_of(df: DataFrame, day: str) -> list[dt.date]:
    """Months in which a frame has rows, one number of dates that follows the calendar and not the rows."""
    return [r[0] for r in df.select(F.trunc(day, "month")).distinct().collect() if r[0] is not None]


def store(tables: Tables, root: str, names: Sequence[str] | None = None,
          files_per_month: int = 1) -> str:
    """Write logical tables below ``root``; facts are split by month of their day column.

    Texts are trimmed here, once. The versions of a fact (:data:`VERSION_OF`) are listed beside it, month by month.
    """
    for name in names or tables:
        df = _trimmed(tables[name])
        if name not in DAY_OF:
            df.write.mode("overwrite").parquet(f"{root}/{name}")
            continue
        _write_months(df, root, name, len(_months_of(df, DAY_OF[name])), files_per_month, "static")
        if name in VERSION_OF:
            _write_versions(df.sparkSession, root, name, "static")
    return root


def append_months(rows: DataFrame, root: str, name: str, files_per_month: int = 1) -> list[dt.date]:
    """Add the months of ``rows`` to a stored fact, or replace them; other months are neither read nor written.

    ``rows`` are all rows of their months. Facts come first, then the lists of the same months, so a job that fails in between is mended by
    running it again. Returns the months.
    """
    df = _trimmed(rows).select(*StructType.fromDDL(SCHEMAS[name]).names)
    months = _months_of(df, DAY_OF[name])
    if months:
        _write_months(df, root, name, len(months), files_per_month, "dynamic")
        if name in VERSION_OF:
            _write_versions(df.sparkSession, root, name, "dynamic", months)
    return sorted(months)
