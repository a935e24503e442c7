"""Publishing results: tables and views over version folders, switched by a pointer, with retention of old versions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources import files

VERSION = "version-"
READERS = "_readers"
#: A reader's mark counts for so long, in case the reader died.
LEASE_SECONDS = 24 * 3600


def _write_version(df: DataFrame, root: str) -> str:
    path = f"{root.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def refresh_table(df: DataFrame, table: str, root: str) -> DataFrame:
    """Replace all rows of a catalog table, keeping its definition; it is created if missing.

    Columns are matched by position and cast to the table's types, as in INSERT ... SELECT. The rows go to a new version folder below ``root``,
    and then the table's location is switched: readers see the old rows or the new ones, those that have begun go on with the
    old files, and a refresh that fails leaves the table as it was.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        path = _write_version(df, root)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
        return spark.table(table)
    fields = spark.table(table).schema.fields
    if len(fields) != len(df.columns):
        raise ValueError(f"{table} has {len(fields)} columns, the rows have {len(df.columns)}")
    placed = df.toDF(*[f"c{i}" for i in range(len(fields))])
    path = _write_version(placed.select(*[F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]), root)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def target_name(base: str, mode: str) -> str:
    """Name of the result of a run mode, ``members`` + ``INTERNAL`` -> ``members_internal``."""
    if not mode.replace("_", "").isalnum():
        raise ValueError(f"run mode {mode!r} cannot be part of a table name")
    return f"{base}_{mode.lower()}"


def publish_version(df: DataFrame, root: str, view: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Write a new version folder below ``root``, then point the catalog's ``view`` at it, with fixed columns.

    Other sessions see the view, and see the old rows or the new ones, never a half-written folder; a
    refresh that fails leaves the old version. Old versions stay for the readers that have begun, until
    :func:`vacuum` removes them. Dates that follow the current day are those of the refresh; see :func:`publish_live`.
    """
    spark = df.sparkSession
    names = list(columns or df.columns)
    path = _write_version(df.select(*names), root)
    listed = ", ".join(f"`{c}`" for c in names)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM parquet.`{path}`")
    return spark.table(view)


def publish_live(df: DataFrame, root: str, view: str, columns: Mapping[str, str], condition: str) -> DataFrame:
    """Publish a version that is windowed when it is read: a view that follows the current date, and a table function for any date.

    ``columns`` maps the declared columns to SQL over the columns of ``df``, and ``condition`` filters its rows; both may hold ``{as_of}``. The view
    puts ``current_date()`` there at each read; the function ``<view>_at(as_of DATE)`` its argument. Both read the stored rows only, and the
    filter reaches the scan.
    """
    spark = df.sparkSession
    path = _write_version(df, root)

    def body(as_of: str) -> str:
        listed = ", ".join(f"{sql.replace('{as_of}', as_of)} AS `{c}`" for c, sql in columns.items())
        return f"SELECT {listed} FROM parquet.`{path}` WHERE {condition.replace('{as_of}', as_of)}"

    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {body('current_date()')}")
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(view).schema.fields)
    spark.sql(f"CREATE OR REPLACE FUNCTION {view}_at(as_of DATE) RETURNS TABLE({declared}) RETURN {body(f'{view}_at.as_of')}")
    return spark.table(view)


def _pointers(spark: SparkSession, names: Sequence[str]) -> str:
    """The definitions of tables, views and functions: every path that they read is in this text."""
    rows = []
    for name in names:
        kind = "TABLE" if spark.catalog.tableExists(name) else "FUNCTION"
        rows += spark.sql(f"DESCRIBE {kind} EXTENDED {name}").collect()
    return "\n".join(str(x) for r in rows for x in r)


@contextmanager
def reading(spark: SparkSession, root: str, name: str) -> Iterator[DataFrame]:
    """The current rows of a published table or view, whose versions :func:`vacuum` leaves alone until the block ends."""
    text = _pointers(spark, [name])
    used = [v for v in files.names(spark, root) if v.startswith(VERSION) and v in text]
    marks = [f"{root.rstrip('/')}/{READERS}/{v}.{uuid.uuid4().hex}" for v in used]
    for m in marks:
        files.mark(spark, m)
    try:
        yield spark.table(name)
    finally:
        for m in marks:
            files.remove(spark, m)


def vacuum(spark: SparkSession, root: str, *names: str, grace_seconds: float = 7 * 24 * 3600) -> list[str]:
    """Remove versions below ``root`` that none of ``names`` points at, that no reader has marked, and that are older than the grace period.

    Give every table, view and function that is published below ``root``. Returns the removed versions. A version that a
    running refresh is writing is young, so the grace period must exceed the longest refresh.
    """
    root, now = root.rstrip("/"), time.time()
    text = _pointers(spark, names)
    marks = [m for m in files.names(spark, f"{root}/{READERS}") if now - files.modified(spark, f"{root}/{READERS}/{m}") < LEASE_SECONDS]
    held = {m.split(".")[0] for m in marks}
    old = [v for v in files.names(spark, root) if v.startswith(VERSION) and v not in text and v not in held
           and now - files.modified(spark, f"{root}/{v}") >= grace_seconds]
    for v in old:
        files.remove(spark, f"{root}/{v}")
    return old


def publish_bucketed(df: DataFrame, root: str, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a new version of a table whose rows are dealt to ``buckets`` by ``keys``: tables bucketed alike join and group by the keys without
    an exchange. Each version is a table of its own, named after it, so readers
    of the version before are not disturbed."""
    name = f"{table}_{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{VERSION}{name.rsplit('_', 1)[1]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)
