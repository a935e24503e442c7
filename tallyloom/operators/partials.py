"""Stored daily partial sums of a fact, refreshed by new days only, from which periods of any grain are merged.

A partial is one row per day and key: the sums of the day. It merges: sums of partials are the sums of their rows, and as each row stands for
one day, distinct days are counted by :func:`tallyloom.operators.grains.multi_grain` as over the fact itself. Each day has a folder of its own and a
commit mark that is set after the folder is in place, so a refresh that fails half-way leaves days without a mark, which are not read and are
done again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources import files
from tallyloom.sources.schemas import DAY_OF
from tallyloom.sources.tables import Tables


def month_ranges(days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Closed ranges of whole months that hold ``days``; months that follow each other are one range."""
    out: list[tuple[dt.date, dt.date]] = []
    for first in sorted({d.replace(day=1) for d in days}):
        last = (first + dt.timedelta(31)).replace(day=1) - dt.timedelta(1)
        out.append((out.pop()[0] if out and out[-1][1] + dt.timedelta(1) == first else first, last))
    return out


class DayPartials:
    """Partial sums of the fact ``name`` by ``keys``, below ``root``. ``where`` limits the rows; it must not change between refreshes."""

    def __init__(self, tables: Tables, name: str, root: str, keys: Sequence[str], sums: Mapping[str, Column], where: Column | None = None):
        self.tables, self.name, self.root = tables, name, root.rstrip("/")
        self.keys, self.sums, self.where, self.day = list(keys), dict(sums), where, DAY_OF[name]

    def _summed(self, rows: DataFrame) -> DataFrame:
        rows = rows if self.where is None else rows.filter(self.where)
        return rows.groupBy(self.day, *self.keys).agg(*[F.sum(c).alias(n) for n, c in self.sums.items()])

    def committed(self) -> set[dt.date]:
        """Days that are in place."""
        return {dt.date.fromisoformat(x) for x in files.names(self.tables.spark, f"{self.root}/marks")}

    def rows_of(self, days: Iterable[dt.date]) -> DataFrame:
        """Rows of the fact that a refresh of ``days`` reads: those days, and no other month folder."""
        days = sorted(set(days))
        if not days:
            return self.tables[self.name].limit(0)
        return self.tables.days(self.name, *month_ranges(days)).filter(F.col(self.day).isin(*days))

    def refresh(self, days: Iterable[dt.date] | None = None, again: Iterable[dt.date] = ()) -> list[dt.date]:
        """Add the days that are not yet in place, and do ``again`` those that have changed; the done days, in order.

        ``days`` are all days of the fact; by default its stored list of days tells, without a look at the fact. Days that the fact
        no longer has go.
        """
        spark = self.tables.spark
        if days is None:
            days = [r[0] for r in self.tables.versions(self.name).select(self.day).distinct().collect()]
        given = {d for d in days if d is not None}
        before = self.committed()
        for d in before - given:
            self._clear(d)
        new = sorted((given - before) | (given & set(again)))
        if not new:
            return []
        pending = f"{self.root}/pending-{uuid.uuid4().hex}"
        try:
            part = self._summed(self.rows_of(new)).withColumn("of_day", F.col(self.day))
            part.repartition("of_day", F.pmod(F.xxhash64(*self.keys), F.lit(8)) if self.keys else F.lit(0)).write.partitionBy("of_day").parquet(pending)
            for d in new:
                self._clear(d)
                if files.exists(spark, f"{pending}/of_day={d}"):
                    files.rename(spark, f"{pending}/of_day={d}", f"{self.root}/cells/of_day={d}")
                files.mark(spark, f"{self.root}/marks/{d}")
        finally:
            files.remove(spark, pending)
        return new

    def _clear(self, day: dt.date) -> None:
        """Take a day out: the mark first, so that a folder without mark is never read."""
        files.remove(self.tables.spark, f"{self.root}/marks/{day}")
        files.remove(self.tables.spark, f"{self.root}/cells/of_day={day}")

    def frame(self) -> DataFrame:
        """All partials in place: the day, the keys and the sums. The files are listed now, so a later refresh needs a new frame."""
        spark, schema = self.tables.spark, self._summed(self.tables[self.name]).schema
        held, marked = files.names(spark, f"{self.root}/cells"), self.committed()
        if not held:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", f"{self.root}/cells").parquet(
            *([f"{self.root}/cells"] if all(dt.date.fromisoformat(h.split("=")[1]) in marked for h in held)
              else [f"{self.root}/cells/{h}" for h in held if dt.date.fromisoformat(h.split("=")[1]) in marked] or [f"{self.root}/cells"]))
        return rows.select(*schema.names) if marked else rows.select(*schema.names).limit(0)
