"""Properties that hold for the whole sample."""

import random

from pyspark.sql import functions as F

from tallyloom.coverage.sample_params import REPORTS
from tallyloom.functions import calendar
from tallyloom.operators.grains import multi_grain
from tallyloom.operators.joins import full_pair
from tallyloom.plans import member_comparison, wbr
from tallyloom.sources.sample import sample_tables


def sums(df, *keys):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*keys).agg(F.sum("n")).collect()}


def test_grains_equal_separate_aggregates(spark, sf_dir):
    facts = sample_tables(spark, sf_dir)["shipment_actuals"].select("country_code", "target_day", F.col("shipped_units").alias("n"))
    rolled = multi_grain(facts, "target_day", ["country_code"], {"n": F.col("n")}, distinct_days="days")
    for grain in calendar.GRAINS:
        want = facts.groupBy("country_code", calendar.period_start(F.col("target_day"), grain).alias("p")).agg(
            F.sum("n").alias("n"), F.countDistinct("target_day").alias("days"))
        got = rolled.filter(F.col("date_granularity") == grain).select("country_code", F.col("target_day").alias("p"), "n", "days")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    totals = {r[0]: r[1] for r in rolled.groupBy("date_granularity").agg(F.sum("n")).collect()}
    assert len(totals) == 4 and len(set(totals.values())) == 1


def test_full_pair_row_count(spark, sf_dir):
    t = sample_tables(spark, sf_dir)
    keys = ["country_code", "target_day"]
    left = t["shipment_actuals"].filter("channel = 'ret'").groupBy(*keys).agg(F.sum("shipped_units").alias("a"))
    right = t["shipment_forecasts"].filter("portfolio_id = '20010601a'").groupBy(*keys).agg(F.sum("shipped_units").alias("b"))
    both = left.join(right, keys).count()
    assert full_pair(left, right, keys).count() == left.count() + right.count() - both


def test_portfolios_have_one_dataset(spark, sf_dir):
    listed = wbr.ranked_portfolios(sample_tables(spark, sf_dir))
    assert listed.groupBy("dataset_date").count().filter("count > 1").count() == 0


def test_input_order_does_not_matter(spark, sf_dir):
    t = sample_tables(spark, sf_dir)
    module, params = REPORTS["report_category_yoy"]
    shuffled = t.replaced(orders_actuals=t["orders_actuals"].orderBy(F.xxhash64("net_ordered_gms", F.lit(random.random()))))
    assert sorted(map(str, module.report(t, params).collect())) == sorted(map(str, module.report(shuffled, params).collect()))


def test_closed_mode_drops_tests_and_drafts(spark, sf_dir):
    t = sample_tables(spark, sf_dir)
    inside = {r[0] for r in member_comparison.portfolios(t, member_comparison.INTERNAL, "2001-01-01").collect()}
    outside = {r[0] for r in member_comparison.portfolios(t, "EXTERNAL", "2001-01-01").collect()}
    assert outside < inside and {"20010601pit", "20010615d"} <= inside - outside
