"""Storage layouts, partials and distributed forms of the operators: what is read, moved and repeated."""

import datetime as dt
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyloom.coverage import CASES
from tallyloom.coverage.sample_params import REPORTS
from tallyloom.functions import calendar
from tallyloom.operators.distinct import BITS, counts_of, dense_texts, partial_bitmaps
from tallyloom.operators.grains import multi_grain, roll_cells
from tallyloom.operators.joins import full_pair, range_join, range_nodes
from tallyloom.operators.partials import DayPartials, month_ranges
from tallyloom.operators.selection import newest, ranked, ranked_globally, with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans import wbr
from tallyloom.sources import sample, sinks, tables
from tallyloom.sources.sample import sample_tables
from tallyloom.sources.schemas import CLUSTERED_BY, SCHEMAS, VERSION_OF
from tallyloom.sources.tables import append_months, store, stored_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def scanned(spark, df):
    """Rows that the file scans of a query give to what lies above them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        if hasattr(node, "plan") and "QueryStage" in name:
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


# --- files clustered by id -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def facts(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    names = ["shipment_forecasts", "orders_forecast_daily", "member_actuals", "member_runs"]
    store(sample_tables(spark, sf_dir), root, names)
    return root


def test_months_are_sorted_by_id(spark, facts):
    import pyarrow.parquet as pq
    for name in ("shipment_forecasts", "member_runs"):
        column = CLUSTERED_BY[name][0]
        for folder, _, found in os.walk(f"{facts}/{name}"):
            for f in found:
                if f.endswith(".parquet"):
                    ids = pq.read_table(f"{folder}/{f}", columns=[column], partitioning=None)[column].to_pylist()
                    assert ids == sorted(ids)


def test_few_ids_read_few_rows(spark, tmp_path):
    """A hundred portfolios of a month, one of them a third of all rows, in four files: two ids read the row groups that hold them."""
    columns = [f.split(" ")[0] for f in SCHEMAS["shipment_forecasts"].split(", ")]
    pid = F.when(F.col("id") % 3 == 0, F.lit("p000")).otherwise(F.format_string("p%03d", F.col("id") % 100))
    rows = spark.range(200_000).withColumns({"portfolio_id": pid, "target_day": F.date_add(F.lit("2001-03-01").cast("date"), (F.col("id") % 31).cast("int"))})
    schema = spark.createDataFrame([], SCHEMAS["shipment_forecasts"]).schema
    rows = rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) if c in ("portfolio_id", "target_day") else F.lit(None).cast(schema[c].dataType).alias(c) for c in columns])
    append_months(rows, str(tmp_path), "shipment_forecasts", files_per_month=4)
    month = tmp_path / "shipment_forecasts" / "month=2001-03-01"
    assert len(list(month.glob("*.parquet"))) == 4
    sizes = [f.stat().st_size for f in month.glob("*.parquet")]
    t = stored_tables(spark, str(tmp_path))
    ids = stage(spark.createDataFrame([("p017",), ("p018",)], "portfolio_id string"))
    chosen = with_ids(t.days("shipment_forecasts", ("2001-03-01", "2001-03-31")), ids, "portfolio_id").select("portfolio_id", "target_day")
    plain = t.days("shipment_forecasts", ("2001-03-01", "2001-03-31")).join(ids, "portfolio_id").select("portfolio_id", "target_day")
    assert rows_of(chosen) == rows_of(plain) and chosen.count() > 2000
    assert scanned(spark, chosen) < 80_000 < 200_000 <= scanned(spark, plain) + 0 * sum(sizes)
    assert "In(portfolio_id" in plan_of(chosen) or "portfolio_id#" in plan_of(chosen)


@pytest.mark.parametrize("n", [0, 3, 300])
def test_id_lists_of_any_length_choose_the_same_rows(spark, n):
    rows = spark.range(2000).select((F.col("id") % 500).alias("k"), "id")
    ids = stage(spark.range(n).select(F.col("id").alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)")))
    for how in ("inner", "left_semi"):
        assert rows_of(with_ids(rows, ids, "k", how=how)) == rows_of(rows.join(ids, "k", how))


# --- months appended ----------------------------------------------------------------------------------------------------

def test_append_months(spark, sf_dir, tmp_path):
    t, root, name = sample_tables(spark, sf_dir), str(tmp_path), "orders_forecast_daily"
    whole = t[name]
    last = whole.agg(F.trunc(F.max("target_day"), "month")).first()[0]
    earlier, newest_month = whole.filter(F.col("target_day") < last), whole.filter(F.col("target_day") >= last)
    store(t.replaced(**{name: earlier}), root, [name])
    state = lambda: {p: os.stat(p).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if not f.endswith("SUCCESS") and not f.startswith("._") for p in [f"{d}/{f}"]}
    before = state()
    for _ in range(2):  # replacing a month gives the same
        assert append_months(newest_month, root, name) == [last]
    after = state()
    assert {p: m for p, m in after.items() if f"month={last}" not in p} == before
    stored = stored_tables(spark, root)
    assert rows_of(stored[name]) == rows_of(whole)
    listed = stored.versions(name)
    assert rows_of(listed) == rows_of(whole.select(*VERSION_OF[name]).distinct()) and all("/versions/" in f for f in listed.inputFiles())
    assert append_months(newest_month.limit(0), root, name) == []


# --- stored partials ------------------------------------------------------------------------------------------------------

def test_partials_read_new_days_only(spark, sf_dir, facts, tmp_path):
    t, name = stored_tables(spark, facts), "member_actuals"
    keys, sums = ["country_code", "customer_group"], {"members": F.col("member_count"), "starts": F.col("start_count")}
    days = sorted(r[0] for r in t.versions(name).select("target_day").distinct().collect())
    part = DayPartials(t, name, str(tmp_path / "p"), keys, sums)
    assert part.frame().count() == 0 and part.refresh(days[:-1]) == days[:-1]
    assert part.refresh() == [days[-1]] and part.refresh() == []
    read = part.rows_of([days[-1]])
    month = t[name].filter(F.trunc("target_day", "month") == days[-1].replace(day=1)).count()
    assert read.count() <= month < t[name].count() and scanned(spark, read) <= month
    for grains in (None, ("Monthly",)):
        more = {} if grains is None else {"grains": grains}
        want = multi_grain(t[name], "target_day", keys, sums, distinct_days="n", **more)
        got = multi_grain(part.frame(), "target_day", keys, {n: F.col(n) for n in sums}, distinct_days="n", **more)
        assert rows_of(got, *want.columns) == rows_of(want)


def test_partials_after_changes_and_failures(spark, facts, tmp_path):
    t, name = stored_tables(spark, facts), "member_actuals"
    part = DayPartials(t, name, str(tmp_path / "p"), ["country_code"], {"members": F.col("member_count")}, where=F.col("country_code") != "US")
    days = part.refresh()
    want = rows_of(t[name].filter("country_code <> 'US'").groupBy("target_day", "country_code").agg(F.sum("member_count").alias("members")))
    assert rows_of(part.frame()) == want
    os.remove(f"{tmp_path}/p/marks/{days[3]}")  # as if the job had stopped between folder and mark: not read, done again
    assert rows_of(part.frame()) == [r for r in want if r[0] != days[3]]
    assert part.refresh() == [days[3]] and rows_of(part.frame()) == want
    changed = t.replaced(member_actuals=t[name].withColumn("member_count", F.when(F.col("target_day") == days[5], 1).otherwise(F.col("member_count")).cast("long")))
    other = DayPartials(changed, name, str(tmp_path / "p"), ["country_code"], {"members": F.col("member_count")}, where=F.col("country_code") != "US")
    assert other.refresh(again=[days[5]]) == [days[5]]
    assert rows_of(other.frame()) == rows_of(changed[name].filter("country_code <> 'US'").groupBy("target_day", "country_code").agg(F.sum("member_count").alias("members")))
    assert other.refresh(days[:4]) == [] and {r[0] for r in rows_of(other.frame())} <= set(days[:4])  # days that are gone go


def test_month_ranges():
    days = [dt.date(2000, 12, 31), dt.date(2001, 1, 1), dt.date(2000, 2, 29), dt.date(2001, 1, 9), dt.date(2001, 3, 1)]
    assert month_ranges([]) == [] and month_ranges(days) == [
        (dt.date(2000, 2, 1), dt.date(2000, 2, 29)), (dt.date(2000, 12, 1), dt.date(2001, 1, 31)), (dt.date(2001, 3, 1), dt.date(2001, 3, 31))]


# --- ranges ---------------------------------------------------------------------------------------------------------------

def test_open_ended_ranges_make_few_rows(spark):
    ranges = spark.range(100_000).select((F.col("id") * 7).cast("int").alias("lo"), F.lit(2_147_483_647).alias("hi"))
    spread, _ = range_nodes(ranges, "lo", "hi")
    assert spread.count() <= 34 * 100_000
    values = spark.createDataFrame([(0,), (69,), (70,), (350_000,)], "v int")
    found = dict(rows_of(range_join(values, ranges.withColumn("n", F.lit(1)), F.col("v"), "lo", "hi").groupBy("v").count()))
    assert found == {0: 1, 69: 10, 70: 11, 350_000: 50_001}


@pytest.mark.parametrize("seed", range(4))
def test_range_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    scale = rng.choice([5, 200, 10_000])
    ranges = [(a, a + rng.choice([0, 1, 3, scale, 10 * scale, 2_000_000_000 - a]), i) for i, a in
              ((i, rng.randint(-scale, scale)) for i in range(rng.choice([1, 2, 33, 100])))]
    values = [rng.randint(-2 * scale, 2 * scale) for _ in range(200)] + [None, 2_000_000_000]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = rows_of(range_join(df, spark.createDataFrame(ranges, "lo int, hi int, n int"), F.col("v"), "lo", "hi"))
    assert got == sorted(((v, n) for v in values if v is not None for lo, hi, n in ranges if lo <= v <= hi), key=str)


# --- distinct counts and ranks ----------------------------------------------------------------------------------------------

def test_bitmaps_count_distinct_values(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.format_string("t%d", F.col("id") % 37).alias("t"),
                                  (F.col("id") * 977 % 90_001 - 30_000).alias("n")).union(spark.sql("SELECT 7L, NULL, NULL")).union(spark.sql("SELECT NULL, 'x', 5L"))
    coded = df.join(dense_texts(df, "t"), "t", "left")
    codes = {"ts": F.col("code"), "ns": F.col("n")}
    want = rows_of(df.groupBy("k").agg(F.countDistinct("t").alias("ts"), F.countDistinct("n").alias("ns")))
    counted = counts_of(partial_bitmaps(coded, ["k"], codes), ["k"], ["ts", "ns"])
    assert rows_of(counted, "k", "ts", "ns") == want and "Expand" not in plan_of(counted) and BITS == 32_768
    halves = [stage(partial_bitmaps(coded.filter(c), ["k"], codes)) for c in ("n % 2 = 0", "n IS NULL OR n % 2 <> 0")]
    assert rows_of(counts_of(halves[0].union(halves[1]), ["k"], ["ts", "ns"]), "k", "ts", "ns") == want


def test_global_rank_without_gathering(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 != 1, F.col("id") * 7919 % 5003).alias("a"),
                                    (F.col("id") % 11).cast("string").alias("b"), "id").repartition(7)
    for order in ({"a": True}, {"a": True, "b": False}, {"b": True}):
        got = ranked_globally(df, order)
        want = ranked(df, [F.desc_nulls_last(k) if x else F.asc_nulls_last(k) for k, x in order.items()])
        assert rows_of(got, "id", "rank") == rows_of(want, "id", "rank")
        assert "SinglePartition" not in plan_of(got) and "SinglePartition" in plan_of(want)
    assert ranked_globally(df.limit(0), {"a": True}).count() == 0 and newest("a")


# --- co-partitioned storage --------------------------------------------------------------------------------------------------

def test_bucketed_tables_join_without_exchange(spark, sf_dir, tmp_path):
    t, keys = sample_tables(spark, sf_dir), ["country_code", "gl_product_group", "target_day"]
    sums = [t[n].groupBy(*keys).agg(F.sum("shipped_units").alias(n)) for n in ("shipment_forecasts", "shipment_actuals")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (sinks.publish_bucketed(s, str(tmp_path), s.columns[-1], keys, 8) for s in sums)
        paired = full_pair(left, right, keys)
        assert "Exchange" not in plan_of(paired) and "SortMergeJoin" in plan_of(paired)
        assert rows_of(paired) == rows_of(full_pair(*sums, keys)) and len(sinks.files.names(spark, str(tmp_path))) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_days_come_from_lists(spark, facts):
    t = stored_tables(spark, facts)
    last = t.versions("member_actuals").filter(calendar.weekday(F.col("target_day")) == 6).agg(F.max("target_day"))
    assert all("/versions/" in f for f in last.inputFiles())
    assert last.first() == t["member_actuals"].filter(calendar.weekday(F.col("target_day")) == 6).agg(F.max("target_day")).first()


def test_cells_are_exchanged_once_and_not_their_copies(spark):
    days = [dt.date(2019, 12, 25) + dt.timedelta(i) for i in range(20)]
    facts = spark.createDataFrame([(k, d, i) for k in ("a", "b", None) for i, d in enumerate(days)], "k string, day date, n bigint")
    cells = facts.groupBy("k", F.greatest(calendar.week_start(F.col("day")), F.trunc("day", "month")).alias("day")).agg(F.sum("n").alias("n"))
    rolled = roll_cells(stage(cells, "cells"), "day", ["k"], ["n"])
    assert plan_of(rolled).count("Exchange hashpartitioning") == 1
    columns = ("date_granularity", "k", "target_day", "n")
    assert rows_of(rolled, *columns) == rows_of(multi_grain(facts, "day", ["k"], {"n": F.col("n")}), *columns)


def test_a_portfolio_of_two_datasets_counts_once(spark, sf_dir):
    t = sample_tables(spark, sf_dir)
    params = replace(REPORTS["report_wbr"][1], portfolios=1000)
    facts = t["shipment_forecasts"]
    again = facts.withColumn("dataset_date", F.lit("1900-01-01").cast("date"))  # no dataset of orders has this date
    want = rows_of(wbr.report(t, params))
    assert rows_of(wbr.report(t.replaced(shipment_forecasts=facts.union(again)), params)) == want and want


# --- sales that many facts are made from ---------------------------------------------------------------------------------

def test_the_last_join_of_the_sales_has_as_many_tasks_as_the_lines_need(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    few = sample_tables(spark, sf_dir)["base_sales"]
    monkeypatch.setattr(sample, "LINES_PER_TASK", 400)
    many = sample_tables(spark, sf_dir)["base_sales"]
    assert "REPARTITION_BY_NUM" not in plan_of(few)
    assert f"{lines // 400}), REPARTITION_BY_NUM" in plan_of(many)
    assert rows_of(many) == rows_of(few)


@pytest.mark.parametrize("name", ["report_ship_order_actuals", "report_wbr"])
def test_a_report_joins_the_sales_once(spark, sf_dir, name):
    assert "l_orderkey" not in plan_of(CASES[name].build(sample_tables(spark, sf_dir)))


def test_staged_sales_are_read_in_large_tasks(spark, sf_dir, monkeypatch):
    cores, size = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.files.maxPartitionBytes")
    sales = sample_tables(spark, sf_dir).staged("base_sales")["base_sales"]
    rows = sales.count()
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        assert spark.read.parquet(*sales.inputFiles()).rdd.getNumPartitions() > 3 * cores
        few = sample_tables(spark, sf_dir).staged("base_sales")["base_sales"]
        assert few.rdd.getNumPartitions() == cores
        monkeypatch.setattr(tables, "ROWS_PER_TASK", rows // (2 * cores))
        assert sample_tables(spark, sf_dir).staged("base_sales")["base_sales"].rdd.getNumPartitions() == rows // (rows // (2 * cores))
        assert rows_of(few) == rows_of(sample_tables(spark, sf_dir)["base_sales"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
