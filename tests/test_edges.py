"""Hand-computed cases on tiny frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.coverage import CASES
from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.grains import final_and_system, multi_grain
from tallyloom.operators.joins import beside_prior_year, full_pair, range_join, rates_of, specific_or_default, wildcard_left, with_rate
from tallyloom.operators.selection import latest_id_per, latest_versions, newest, newest_rows, only_value, top_ranked
from tallyloom.operators.staging import stage
from tallyloom.sources.sample import sample_tables

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_rank_ties_go_beyond_n(spark):
    df = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "id string, t int")
    assert rows(top_ranked(df, 2, newest("t")), "id", "rank") == [("a", 1), ("b", 2), ("c", 2)]


def test_null_order_comes_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "id string, t int")
    assert rows(top_ranked(df, 1, newest("t")), "id") == [("b",)]


def test_latest_versions_keep_ties_once(spark):
    df = spark.createDataFrame([("p", "s1", 1), ("p", "s2", 2), ("p", "s3", 2), ("p", "s3", 2), ("q", "s4", 1)], "k string, s string, t int")
    assert rows(latest_versions(df, ["k"], "t"), "k", "s") == [("p", "s2"), ("p", "s3"), ("q", "s4")]


def test_newest_rows_is_exact(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "id string, t int")
    assert rows(newest_rows(df, 1, "t", "id"), "id") == [("c",)]


def test_text_ids_compare_as_text(spark):
    df = spark.createDataFrame([(1, "9"), (1, "10"), (2, "7")], "d int, id string")
    assert rows(latest_id_per(df, "d", "id")) == [(1, "9"), (2, "7")]


def test_wildcard_lookup(spark):
    facts = spark.createDataFrame([("US", 14, "x", 1), ("US", 14, None, 2), ("US", 14, "y", 3), ("FR", 1, "x", 4)],
                                  "country_code string, gl_product_group int, category_code string, n int")
    lookup = spark.createDataFrame([("US", 14, None, "any"), ("US", 14, "x", "exact")],
                                   "country_code string, gl_product_group int, category_code string, promise_extension string")
    found = wildcard_left(facts, lookup, ("country_code", "gl_product_group"), "category_code", ["promise_extension"])
    assert rows(found, "n", "promise_extension") == sorted([(1, "any"), (1, "exact"), (2, None), (3, "any"), (4, None)], key=str)


def test_specific_else_default_else_constant(spark):
    facts = spark.createDataFrame([("US", 14, "x"), ("US", 15, "x"), ("FR", 14, "x"), ("US", 0, "x")],
                                  "country_code string, gl_product_group int, category_code string")
    lookup = spark.createDataFrame([("US", 0, None, "default"), ("US", 14, None, "own")],
                                   "country_code string, gl_product_group int, category_code string, promise_extension string")
    out = specific_or_default(facts, lookup, "promise_extension", otherwise="none")
    assert rows(out, "country_code", "gl_product_group", "promise_extension") == [
        ("FR", 14, "none"), ("US", 0, "default"), ("US", 14, "own"), ("US", 15, "default")]
    bare = specific_or_default(facts.filter("country_code = 'FR'"), lookup, "promise_extension")
    assert rows(bare, "promise_extension") == [(None,)]


def test_missing_rate(spark):
    facts = spark.createDataFrame([("US", Decimal("2.0000")), ("ES", Decimal("3.0000"))], "country_code string, v decimal(18,4)")
    fx = spark.createDataFrame([("US", "US", "s", Decimal("1.5")), ("US", "DE", "s", Decimal("9")), ("US", "US", "old", Decimal("7"))],
                               "source_country_code string, target_country_code string, scenario string, fx_rate decimal(12,6)")
    rates = rates_of(fx, "s")
    value = measures.as_number(measures.converted(F.col("v"))).alias("v")
    assert rows(with_rate(facts, rates).select("country_code", value)) == [("US", 3.0)]
    assert rows(with_rate(facts, rates, "left").select("country_code", value)) == [("ES", None), ("US", 3.0)]


def test_totals_stay_exact(spark):
    df = spark.createDataFrame([(Decimal("123456789012.123456"), Decimal("0.752101"))], "v decimal(28,6), fx_rate decimal(12,6)")
    got = df.select(measures.converted_total(F.col("v"))).first()[0]
    assert got == Decimal("123456789012.123456") * Decimal("0.752101")


def test_scalar_pointer(spark):
    one = spark.createDataFrame([("s",)], "scenario string")
    fx = spark.createDataFrame([("US", "US", "s", Decimal("1"))],
                               "source_country_code string, target_country_code string, scenario string, fx_rate decimal(12,6)")
    assert rates_of(fx, only_value(one, "scenario")).count() == 1
    assert rates_of(fx, only_value(one.filter("false"), "scenario")).count() == 0
    two = spark.createDataFrame([("s",), ("t",)], "scenario string")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        rates_of(fx, only_value(two, "scenario")).collect()


def test_full_pair_does_not_match_null_keys(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, None, 11)], "k int, name string, f int")
    right = spark.createDataFrame([(1, "a", 20), (1, None, 21), (2, "b", 22)], "k int, name string, a int")
    got = rows(full_pair(left, right, ["k", "name"]), "k", "name", "f", "a")
    assert got == sorted([(1, "a", 10, 20), (1, None, 11, None), (1, None, None, 21), (2, "b", None, 22)], key=str)


def test_range_join_equals_the_plain_condition(spark):
    ranges = spark.createDataFrame([(0, 1, "a"), (2, 40, "b"), (30, 999, "c"), (-20, -3, "d")], "lo int, hi int, n string")
    values = spark.range(-25, 1005).select(F.col("id").cast("int").alias("v"))
    got = rows(range_join(values, ranges, F.col("v"), "lo", "hi"), "v", "n")
    want = [(v, n) for v in range(-25, 1005) for lo, hi, n in ((0, 1, "a"), (2, 40, "b"), (30, 999, "c"), (-20, -3, "d")) if lo <= v <= hi]
    assert got == sorted(want, key=str)


def test_range_join_is_bounded_with_open_ends(spark):
    bounds = [(0, 1, "a"), (2, 40, "b"), (30, 2_147_483_647, "open"), (None, 5, "no start"), (7, None, "no end"), (9, 8, "empty")]
    ranges = spark.createDataFrame(bounds, "lo int, hi int, n string")
    values = spark.createDataFrame([(0,), (35,), (2_147_483_647,), (None,), (-5,)], "v int")
    found = range_join(values, ranges, F.col("v"), "lo", "hi")
    assert rows(found, "v", "n") == sorted([(0, "a"), (35, "b"), (35, "open"), (2_147_483_647, "open")], key=str)
    spread = spark.range(1000).select((F.col("id") * 50).cast("int").alias("lo"), (F.col("id") * 50 + 49).cast("int").alias("hi"))
    assert range_join(spark.range(50_000), spread, F.col("id"), "lo", "hi").count() == 50_000


def test_prior_year_partner(spark):
    data = [("a", D(2001, 1, 7), 1), ("a", D(2000, 1, 9), 2), ("a", D(2000, 1, 9), 3), (None, D(2001, 1, 7), 5), (None, D(2000, 1, 9), 7),
            ("b", D(2000, 1, 9), 9)]
    df = spark.createDataFrame(data, "k string, day date, n int")
    day = F.col("day")
    got = rows(beside_prior_year(df, "day", ["k"], {"n": F.col("n")}, current=F.year(day) == 2001, prior=F.year(day) == 2000),
               "k", "target_day", "year", "week", "dow", "n_cy", "n_py")
    # Sunday 7 January 2001 opens week 2; so did Sunday 9 January 2000. A NULL key has no partner.
    assert got == sorted([("a", D(2001, 1, 7), 2001, 2, 0, 1, 5), (None, D(2001, 1, 7), 2001, 2, 0, 5, None)], key=str)


def test_week_53_has_no_partner(spark):
    df = spark.createDataFrame([(D(2021, 1, 2), 1), (D(2020, 1, 4), 2), (D(2022, 1, 1), 4)], "day date, n int")
    everything = F.lit(True)
    got = {r.target_day: r.n_py for r in beside_prior_year(df, "day", [], {"n": F.col("n")}, everything, everything).collect()}
    assert got == {D(2021, 1, 2): None, D(2020, 1, 4): None, D(2022, 1, 1): None}  # weeks 53, 1 and 52
    keys = df.select(calendar.planning_year(F.col("day")), calendar.planning_week(F.col("day"))).collect()
    assert [tuple(k) for k in keys] == [(2020, 53), (2020, 1), (2021, 52)]


@pytest.mark.parametrize("day,start,week,year,label", [
    (D(2020, 12, 27), D(2020, 12, 27), 53, 2020, 2021), (D(2021, 1, 2), D(2020, 12, 27), 53, 2020, 2021),
    (D(2021, 1, 3), D(2021, 1, 3), 1, 2021, 2021), (D(2019, 12, 29), D(2019, 12, 29), 1, 2020, 2020),
    (D(2000, 1, 1), D(1999, 12, 26), 52, 1999, 2000)])
def test_new_year_weeks(spark, day, start, week, year, label):
    d = F.lit(day)
    got = spark.range(1).select(calendar.week_start(d), calendar.planning_week(d), calendar.planning_year(d),
                                calendar.week_label_year(calendar.week_start(d))).first()
    assert tuple(got) == (start, week, year, label)


@pytest.mark.parametrize("later,earlier,months", [
    (D(2001, 2, 28), D(2001, 1, 31), 1), (D(2001, 2, 27), D(2001, 1, 31), 0), (D(2001, 3, 30), D(2001, 2, 28), 1),
    (D(2001, 6, 1), D(2000, 6, 1), 12), (D(2001, 5, 31), D(2000, 6, 1), 11), (D(2000, 1, 1), D(2000, 2, 1), -1)])
def test_whole_months(spark, later, earlier, months):
    assert spark.range(1).select(calendar.whole_months_between(F.lit(later), F.lit(earlier))).first()[0] == months


def test_tenure_band(spark):
    df = spark.createDataFrame([(1, D(2005, 1, 1)), (2, D(2000, 12, 31)), (2, D(2001, 1, 1))], "n int, day date")
    band = labels.tenure_band(F.col("n"), F.col("day"), F.lit(D(2000, 1, 1)))
    assert [r[0] for r in df.select(band).collect()] == ["0", "0", "1"]


def test_id_dates_of_dirty_ids(spark):
    df = spark.createDataFrame([("20010601pit",), ("2001",), ("garbage!",), (None,)], "id string")
    assert [r[0] for r in df.select(calendar.id_date(F.col("id"))).collect()] == [D(2001, 6, 1), None, None, None]


def test_horizon_start(spark):
    days = spark.createDataFrame([(D(2001, 6, 1),), (D(2001, 6, 2),), (D(2001, 6, 3),)], "d date")  # Friday to Sunday
    assert [r[0] for r in days.select(calendar.horizon_start(F.col("d"))).collect()] == [D(2001, 5, 27), D(2001, 6, 3), D(2001, 6, 3)]


def test_null_groups(spark):
    df = spark.createDataFrame([("prm",), ("stu",), ("npr",), (None,)], "g string")
    assert [r[0] for r in df.select(labels.member_class(F.col("g"))).collect()] == ["prm", "prm", "npr", "npr"]
    assert [r[0] for r in df.select(labels.region(F.upper("g"))).collect()] == [None] * 4
    assert spark.range(1).select(labels.product_bucket(F.lit(None).cast("int"))).first()[0] == "others"


def test_brackets_are_literal(spark):
    df = spark.createDataFrame([("run [IN,INT,WW]",), ("run I",)], "d string")
    assert [r[0] for r in df.select(labels.interval_class(F.col("d"))).collect()] == ["IN CI", "other countries CI"]


def test_net_flow_of_null_is_null(spark):
    df = spark.createDataFrame([(1, 2, 3, 4), (1, None, 3, 4)], "a int, b int, c int, d int")
    assert [r[0] for r in df.select(measures.net_flow(*[F.col(c) for c in "abcd"])).collect()] == [-4, None]


def test_per_day_of_zero_days(spark):
    assert spark.range(1).select(measures.per_day(F.lit(1), F.lit(0))).first()[0] is None


def test_final_and_system(spark):
    df = spark.createDataFrame([("p", "Baseline", 1), ("p", "Event", 2), ("q", "Event", 4), ("r", None, 8)], "k string, i string, n int")
    out = final_and_system(df, ["k"], {"n": F.col("n")}, F.col("i") == "Baseline")
    assert rows(out, "k", "initiative", "n") == [("p", "Final", 3), ("p", "System", 1), ("q", "Final", 4), ("r", "Final", 8)]


def test_multi_grain_counts_days_once(spark):
    df = spark.createDataFrame([("a", D(2001, 1, 31), 1), ("a", D(2001, 1, 31), 2), ("a", D(2001, 2, 1), 4), ("a", D(2001, 7, 1), 8)],
                               "k string, day date, n int")
    got = rows(multi_grain(df, "day", ["k"], {"n": F.col("n")}, distinct_days="days"), "date_granularity", "target_day", "n", "days")
    assert got == sorted([
        ("Weekly", D(2001, 1, 28), 7, 2), ("Weekly", D(2001, 7, 1), 8, 1),
        ("Monthly", D(2001, 1, 1), 3, 1), ("Monthly", D(2001, 2, 1), 4, 1), ("Monthly", D(2001, 7, 1), 8, 1),
        ("Quarterly", D(2001, 1, 1), 7, 2), ("Quarterly", D(2001, 7, 1), 8, 1), ("Yearly", D(2001, 1, 1), 15, 3)], key=str)


def test_total_beyond_the_decimal_raises(spark):
    df = spark.createDataFrame([("12345678901234567890.5",)], "v string").select(F.col("v").cast("decimal(38,6)").alias("v"), F.lit(1).alias("fx_rate"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="more than 19 digits"):
                df.select(measures.converted_total(F.col("v"))).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_stage_survives_and_knows_its_size(spark):
    staged = stage(spark.range(5).withColumn("t", F.lit("x")), "unit")
    assert staged.count() == 5 and staged.columns == ["id", "t"]
    assert int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100_000


def test_shipments_keep_the_names_of_the_facts_and_older_datasets_change_nothing(spark, sf_dir):
    t = sample_tables(spark, sf_dir)
    both = t["shipment_actuals_all"]
    assert both.select("dataset_date").distinct().count() == 2 and t["shipment_actuals"].select("dataset_date").distinct().count() == 1
    newest = t.replaced(shipment_actuals_all=both.filter("dataset_date = DATE '2001-07-01'"))
    for build in (CASES["report_wbr"].build, CASES["report_shipment_comparison"].build, CASES["report_ship_order_actuals"].build):
        assert sorted(map(str, build(t).collect())) == sorted(map(str, build(newest).collect()))
    labels = {r[0] for r in CASES["report_shipment_comparison"].build(t).filter("type = 'Shipments'").select("gl_product_group").distinct().collect()}
    assert {"14 - A group", "14 - Group 14", "364 - Unknown", "510 - Unknown"} <= labels


def test_the_comparison_joins_rates_to_sums_of_periods(spark, sf_dir):
    plan = CASES["report_shipment_comparison"].build(sample_tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    operators = [line.lstrip(" :+-") for line in plan.splitlines()]
    joins = [i for i, o in enumerate(operators) if o.startswith("Join Inner, (country_code")]
    assert len(joins) == 1
    below = next(o for o in operators[joins[0] + 1:] if not o.startswith(("Project", "Join", "Filter")))
    assert below.startswith("Aggregate") and "sum(gms#" in below  # that of the periods: the one of the cells sums a choice of amounts


def test_left_join_returns_each_run_row_beside_its_rate(spark):
    day, keys = D(2001, 1, 1), "run_id string, country_code string, customer_group string, plan_status string, plan_type string, target_day date"
    a, b, c = ("r1", "US", "prm", "paid", "annual", day), ("r1", "US", "prm", "paid", "monthly", day), ("r1", "US", "prm", "paid", None, day)
    runs = spark.createDataFrame([(*a, 10), (*a, 11), (*b, 20), (*c, 30)], f"{keys}, member_count bigint")
    rates = spark.createDataFrame([(*a, 0.5), (*b, 0.001), (*c, 0.7)], f"{keys}, cancel_rate double")
    t = sample_tables(spark, "").replaced(member_runs=runs, member_rates=rates)
    assert rows(CASES["join_left_on"].build(t)) == sorted([(*a, 10, 0.5), (*a, 11, 0.5), (*b, 20, None), (*c, 30, None)], key=str)
