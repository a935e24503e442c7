"""Named intermediate results, their release, and the size rule for broadcast sides.

No operator broadcasts on trust. A join side becomes a broadcast because it is read from storage (a
dimension table, or a list put there by :func:`stage`): the planner then knows its file size, broadcasts
below ``spark.sql.autoBroadcastJoinThreshold`` and uses a shuffle join above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import new_folder
from tallyloom.sources import files

_RUN: ContextVar[str | None] = ContextVar("run folder", default=None)


@contextmanager
def run_scope(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """One folder for everything staged inside the block; it goes when the block ends, also after a failure.

    Write the result inside the block: a DataFrame that leaves it may read a staged table that is gone. Scopes nest, each
    with a folder of its own, and each thread (context) has its own. Without a scope staged tables stay, as the caller may
    read them at any time.
    """
    folder = new_folder(spark, label)
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        files.remove(spark, folder)


def current_run() -> str | None:
    """The folder of the innermost run scope, if there is one."""
    return _RUN.get()


def staging_folder(spark: SparkSession, label: str) -> str:
    """A new path for a staged table: below the folder of the run scope, if there is one."""
    path = new_folder(spark, label)
    run = _RUN.get()
    return f"{run}/{path.rsplit('/', 1)[1]}" if run else path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage, outlives lost executors, and gives the planner the true size. Meant for the
    short lists (runs, portfolios, forecast ids) that several branches of a report join to.
    """
    path = staging_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
