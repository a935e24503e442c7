"""Time the reports on the sample data.

Prints one JSON line. Each report is built and written to the ``noop`` sink: one warm-up, then the median
of ``BENCH_RUNS`` runs (2). ``queries`` reads logical tables that were written once (month folders, clustered by id, lists
beside the facts), as on a cluster; ``ingest`` is the time of that writing. With ``BENCH_DERIVED=1`` the same reports also run over
tables that are derived from the raw Parquet inside every run, as the registered queries do.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.coverage.sample_params import REPORTS  # noqa: E402
from tallyloom.operators.staging import run_scope  # noqa: E402
from tallyloom.session import build_session  # noqa: E402
from tallyloom.sources.sample import sample_tables  # noqa: E402
from tallyloom.sources.tables import Tables, store, stored_tables  # noqa: E402
from tallyloom.sources.schemas import SCHEMAS  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def run_once(name: str, tables: Tables) -> float:
    module, params = REPORTS[name]
    start = time.perf_counter()
    module.report(tables, params).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def medians(make_tables, names) -> dict[str, float]:
    result = {}
    for name in names:
        times = [run_once(name, make_tables()) for _ in range(RUNS + 1)][1:]
        result[name] = round(statistics.median(times), 3)
        print(f"{name} {result[name]}", file=sys.stderr, flush=True)
    return result


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
                          spark__sql__shuffle__partitions=str(4 * int(CPUS)), spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in REPORTS if not sys.argv[1:] or n in sys.argv[1:]]
    extra = {}
    with run_scope(spark, "bench") as root:
        start = time.perf_counter()
        store(sample_tables(spark, SF_DIR), root, list(SCHEMAS))
        ingest = time.perf_counter() - start
        stored = medians(lambda: stored_tables(spark, root), names)
        if os.environ.get("BENCH_DERIVED") == "1":
            derived = medians(lambda: sample_tables(spark, SF_DIR), names)
            extra["derived"] = {"value": round(sum(derived.values()), 3), "queries": derived}
    print(json.dumps({
        "metric": "seconds for all reports over stored tables, median of runs, noop sink", "value": round(sum(stored.values()), 3),
        "unit": "sec", "queries": stored, "ingest": round(ingest, 3), "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        **extra,
        "config": {"cores": int(CPUS), "runs": RUNS, "spark": spark.version,
                   "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}}))
    spark.stop()


if __name__ == "__main__":
    main()
