"""Stored tables, sinks, and the plans of the reports over stored tables."""

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyloom.coverage.sample_params import REPORTS
from tallyloom.operators.staging import run_scope, stage
from tallyloom.plans import member_comparison, shipment_comparison, wbr
from tallyloom.session import new_folder, shared_folder
from tallyloom.sources import sinks
from tallyloom.sources.sample import sample_tables
from tallyloom.sources.schemas import DAY_OF, SCHEMAS, VERSION_OF
from tallyloom.sources.tables import catalog_tables, store, stored_tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    store(sample_tables(spark, sf_dir), root, list(SCHEMAS))
    return stored_tables(spark, root)


@pytest.fixture(scope="module")
def plans(stored):
    return {n: m.report(stored, p)._jdf.queryExecution().executedPlan().toString() for n, (m, p) in REPORTS.items()}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_same_result_from_stored_tables(spark, sf_dir, stored, name):
    module, params = REPORTS[name]
    want = module.report(sample_tables(spark, sf_dir), params)
    got = module.report(stored, params)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_plan_shape(plans, name):
    plan = plans[name]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "Scan ExistingRDD" not in plan
    assert "Aggregate" not in plan or "partial_" in plan or "HashAggregate(keys" in plan


@pytest.mark.parametrize("name", sorted(set(REPORTS) - {"report_ci_review", "report_promise_impact"}))
def test_month_folders_are_pruned(plans, name):
    scans = [s for s in plans[name].split("FileScan parquet")[1:] if "month#" in s.split("Batched")[0] or "PartitionFilters: [isnotnull(month" in s]
    assert any(re.search(r"PartitionFilters: \[[^\]]*month#\d+ [<>]=", s) for s in scans), plans[name]


def test_days_test_folder_and_day(stored):
    df = stored.days("orders_actuals", ("2000-03-15", "2000-04-02"))
    assert df.agg(F.min("order_day"), F.max("order_day")).first()[0].isoformat() >= "2000-03-15"
    assert "month" not in df.columns and "month" not in stored["orders_actuals"].columns
    whole = stored["orders_actuals"].filter(F.col("order_day").between("2000-03-15", "2000-04-02"))
    assert df.count() == whole.count() > 0


def test_facts_are_split_by_month(stored):
    assert set(DAY_OF) < set(SCHEMAS)
    plan = stored["shipment_actuals"]._jdf.queryExecution().optimizedPlan().toString()
    assert "month" in plan


def test_global_ranks_cut_their_input_first(stored):
    plan = member_comparison.portfolios(stored, member_comparison.INTERNAL, "2001-01-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and "Partial" in plan


def test_lookups_are_broadcast_by_size(spark, stored):
    module, params = REPORTS["report_promise_impact"]
    small = module.report(stored, params)._jdf.queryExecution().executedPlan().toString()
    assert small.count("BroadcastHashJoin") >= 6
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = module.report(stored, params)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and "NestedLoop" not in plan
        rows = large.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == module.report(stored, params).count()


def test_trimmed_codes(spark, tmp_path):
    t = catalog_tables(spark, {"orders_actuals": "padded_orders"})
    spark.sql("SELECT 'US ' AS country_code, DATE '2001-01-01' AS order_day").createOrReplaceTempView("padded_orders")
    store(t, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/orders_actuals").first().country_code == "US"


def test_refresh_twice_gives_the_same_rows(spark, sf_dir, tmp_path):
    t = sample_tables(spark, sf_dir)
    _, params = REPORTS["report_member_comparison"]
    first = sorted(map(tuple, member_comparison.refresh(t, params, str(tmp_path)).collect()))
    second = sorted(map(tuple, member_comparison.refresh(t, params, str(tmp_path)).collect()))
    assert first == second and first
    assert len(list((tmp_path / "members_internal").iterdir())) == 2
    assert spark.newSession().table("members_internal").count() == len(first)


def test_shipment_refresh(spark, sf_dir, tmp_path):
    _, params = REPORTS["report_shipment_comparison"]
    assert shipment_comparison.refresh(sample_tables(spark, sf_dir), params, str(tmp_path)).count() > 0
    assert (tmp_path / "shipments_internal").is_dir()


def test_refresh_table_switches_and_keeps_its_definition(spark, tmp_path):
    spark.sql(f"CREATE TABLE refreshed (n BIGINT, t STRING) USING parquet LOCATION '{tmp_path}/refreshed'")
    try:
        reader = None
        for n in (3, 5):
            got = sinks.refresh_table(spark.range(n).select(F.col("id").cast("int"), F.lit("x").alias("other_name")), "refreshed", str(tmp_path))
            assert got.columns == ["n", "t"] and got.dtypes == [("n", "bigint"), ("t", "string")] and got.count() == n
            reader = reader or got
        assert reader.count() == 3 and spark.newSession().table("refreshed").count() == 5  # who has begun sees the old rows
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
            sinks.refresh_table(spark.range(4).selectExpr("id", "string(1 / (id - id))"), "refreshed", str(tmp_path))
        assert spark.table("refreshed").count() == 5
        with pytest.raises(ValueError):
            sinks.refresh_table(spark.range(4), "refreshed", str(tmp_path))
    finally:
        spark.sql("DROP TABLE refreshed")


def test_vacuum_keeps_what_is_pointed_at_read_or_young(spark, tmp_path):
    root = str(tmp_path)
    sinks.publish_version(spark.range(2), root, "kept_view")
    with sinks.reading(spark, root, "kept_view") as old:
        for n in (3, 4):
            sinks.publish_version(spark.range(n), root, "kept_view")
        sinks.refresh_table(spark.range(7), "kept_table", root)
        sinks.refresh_table(spark.range(8), "kept_table", root)
        assert sinks.vacuum(spark, root, "kept_view", "kept_table") == []  # all are young
        assert len(sinks.vacuum(spark, root, "kept_view", "kept_table", grace_seconds=0)) == 2  # versions of 3 and of 7 rows
        assert old.count() == 2
    assert len(sinks.vacuum(spark, root, "kept_view", "kept_table", grace_seconds=0)) == 1
    assert spark.table("kept_view").count() == 4 and spark.table("kept_table").count() == 8
    spark.sql("DROP TABLE kept_table")


def test_refresh_leaves_no_staged_folder(spark, sf_dir, tmp_path):
    t, (_, params) = sample_tables(spark, sf_dir), REPORTS["report_member_comparison"]
    before = set(os.listdir(shared_folder(spark)))
    member_comparison.refresh(t, params, str(tmp_path))
    assert set(os.listdir(shared_folder(spark))) == before
    with pytest.raises(ZeroDivisionError):
        with run_scope(spark) as folder:
            stage(spark.range(3))
            with run_scope(spark) as inner:
                stage(spark.range(4))
                assert os.listdir(inner) and os.listdir(folder)
            assert not os.path.exists(inner) and os.listdir(folder)
            1 / 0
    assert not os.path.exists(folder) and set(os.listdir(shared_folder(spark))) == before
    kept = stage(spark.range(5), "kept")  # without a scope it stays
    assert kept.count() == 5 and set(os.listdir(shared_folder(spark))) != before


def test_versions_switch(spark, tmp_path):
    old = sinks.publish_version(spark.range(2), str(tmp_path), "published")
    new = sinks.publish_version(spark.range(5), str(tmp_path), "published")
    assert spark.table("published").count() == new.count() == 5 and old.count() == 2
    assert spark.newSession().table("published").count() == 5
    assert len(list(tmp_path.iterdir())) == 2


def test_target_names():
    assert sinks.target_name("members", "INTERNAL") == "members_internal"
    with pytest.raises(ValueError):
        sinks.target_name("members", "a; b")


def test_declared_view(spark, sf_dir, tmp_path):
    _, params = REPORTS["report_wbr"]
    t = sample_tables(spark, sf_dir)
    view = wbr.create_view(t, params, str(tmp_path), "weekly_review")
    assert view.columns == list(wbr.COLUMNS)
    dates = ("2001-07-01", "1999-06-15", str(spark.sql("SELECT current_date()").first()[0]))
    rows = []
    for as_of in dates:  # one object, any window: as the report of that date
        got = spark.newSession().sql(f"SELECT * FROM weekly_review_at(DATE '{as_of}')")
        assert got.columns == list(wbr.COLUMNS)
        rows.append(sorted(map(str, got.collect())))
        assert rows[-1] == sorted(map(str, wbr.report(t, replace(params, as_of=as_of)).collect()))
    assert rows[0] != rows[1] and sorted(map(str, view.collect())) == rows[2]


def test_shared_folder_is_the_configured_one(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")


def test_version_lists_are_read_beside_the_facts(spark, stored):
    for name, columns in VERSION_OF.items():
        listed = stored.versions(name)
        assert all("/versions/" in f for f in listed.inputFiles())
        assert sorted(map(str, listed.collect())) == sorted(map(str, stored[name].select(*columns).distinct().collect()))
    assert "versions/shipment_forecasts" not in set(stored) and len(stored) == len(set(stored))
    other = stored.replaced(orders_forecast_daily=stored["orders_forecast_daily"].limit(0))
    assert other.versions("orders_forecast_daily").count() == 0


def test_ranks_do_not_read_the_facts(stored):
    for plan in (member_comparison.portfolios(stored, member_comparison.INTERNAL, "2001-01-01"), wbr.ranked_portfolios(stored)):
        assert not [f for f in plan.inputFiles() if "/month=" in f and "/versions/" not in f]
