"""Logical tables derived from the TPC-H-like sample data, for tests and benchmarks.

The rules are those of FIXTURES.md; ``coverage/views.py`` states them again in SQL for the oracle, and
a test compares the two. Facts are narrow transformations of one sales frame: a row is repeated per
portfolio (or member set) by exploding a constant list, never by joining everything with everything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import calendar
from tallyloom.sources.tables import Tables

# Code lists and small reference tables of the sample.
COUNTRIES = ("US", "CA", "UK", "DE", "FR", "IT", "ES", "JP", "IN", "MX")
PRODUCTS = (14, 15, 21, 60, 75, 121, 194, 199, 201, 328, 364, 467, 510, 700, 990, 995)
ROLLUPS = {"MEDIUM": "hdl", "STANDARD": "sft", "LARGE": "con", "PROMO": "med", "ECONOMY": "dig"}
PORTFOLIOS = (
    ("20010101a", "2001-01-01", "PRODUCTION", "Y", 5001, 1.02, "2001-01-05", "root", "true"),
    ("20010201a", "2001-02-01", "PRODUCTION", "Y", 5002, 0.98, "2001-02-05", "root", "true"),
    ("20010301b", "2001-03-01", "PRODUCTION", "Y", 5003, 1.05, "2001-03-05", "ops", "true"),
    ("20010401a", "2001-04-01", "PRODUCTION", "Y", 5004, 1.01, "2001-04-05", "root", "true"),
    ("20010501a", "2001-05-01", "PRODUCTION", "Y", 5005, 0.95, "2001-05-05", "root", "true"),
    ("20010601a", "2001-06-01", "PRODUCTION", "Y", 5006, 1.10, "2001-06-05", "root", "true"),
    ("20010515a", "2001-05-15", "PRODUCTION", "N", 5299, 1.00, "2001-05-16", "root", "false"),
    ("20010601pit", "2001-06-01", "TEST", "N", 5007, 1.04, "2001-06-06", "root", "false"),
    ("20010701pit", "2001-07-01", "TEST", "N", 5008, 1.03, "2001-07-02", "root", "false"),
    ("20010615d", "2001-06-15", "DRAFT", "N", 5009, 0.99, "2001-06-16", "root", "false"),
)
MEMBER_SETS = (
    ("s1", "2001-05-01", "system", "r1"), ("s1", "2001-05-01", "final", "r2"),
    ("s2", "2001-06-01", "system", "r3"), ("s3", "2001-06-01", "system", "r4"),
    ("s3", "2001-06-01", "final", "r5"), ("s3", "2001-03-01", "system", "r6"),
    ("s4", "2001-07-01", "system", "r7"), ("s5", "2001-06-20", "system", "r8"),
    ("s6", "2001-06-21", "final", "r9"),
)
FORECAST_OFFSETS = (("Adjusted", 0), ("Baseline", 1000))
COHORT_MONTHS = ("1999-06-01", "2000-01-01")
QUANTILES = ("0.1", "0.5", "0.9")
FORECAST_REACH = 400


def _rows(rows: Sequence[Sequence[str]]) -> str:
    return ", ".join("(" + ", ".join(r) + ")" for r in rows)


def _portfolio_rows() -> str:
    return _rows([(f"'{i}'", f"DATE '{d}'", f"'{s}'", f"'{y}'", str(f), f"CAST({x} AS DECIMAL(4,2))",
                   f"DATE '{c}'", f"'{b}'", f"'{p}'") for i, d, s, y, f, x, c, b, p in PORTFOLIOS])


def _set_rows() -> str:
    return _rows([(f"'{s}'", f"DATE '{d}'", f"'{c}'", f"'{r}'") for s, d, c, r in MEMBER_SETS])


# Small tables as portable SQL; the same text serves Spark and the oracle.
LITERALS: dict[str, str] = {
    "portfolio_metadata": f"""SELECT * FROM (VALUES {_portfolio_rows()})
  AS t(portfolio_id, dataset_date, portfolio_status, is_latest_publish, forecast_id, factor, creation_date, created_by, published)""",
    "portfolio_pins": "SELECT '20010101a' AS portfolio_id",
    "fx_rates": """SELECT source_country_code, target_country_code, scenario, CAST(r AS DECIMAL(12,6)) AS fx_rate, DATE '2001-01-01' AS updated_date
  FROM (VALUES ('US','US','2001 PLAN',1.000000), ('CA','US','2001 PLAN',0.752100), ('UK','US','2001 PLAN',1.273100),
    ('DE','US','2001 PLAN',1.101500), ('FR','US','2001 PLAN',1.101500), ('IT','US','2001 PLAN',1.101500),
    ('JP','US','2001 PLAN',0.009100), ('IN','US','2001 PLAN',0.014200), ('US','US','2000 PLAN',1.000000),
    ('UK','US','2000 PLAN',1.300000), ('UK','DE','2001 PLAN',1.155700)) AS t(source_country_code, target_country_code, scenario, r)""",
    "fx_scenario": "SELECT '2001 PLAN' AS scenario",
    "dataset_reference": """SELECT * FROM (VALUES (DATE '2001-03-01', '2001-03-01 05-Mar', '2001 PLAN'),
    (DATE '2001-06-01', '2001-06-01 05-Jun', '2001 PLAN')) AS t(dataset_date, data_type_name, fx_scenario)""",
    "promise_extension": """SELECT * FROM (VALUES ('US', 0, CAST(NULL AS VARCHAR(20)), 'Extension_3'), ('UK', 0, NULL, 'Extension_2'),
    ('US', 14, NULL, 'Extension_7'), ('US', 14, 'Brand#1', 'Extension_9'), ('UK', 75, 'Brand#2', 'Extension_5'),
    ('FR', 121, NULL, 'Extension_1')) AS t(country_code, gl_product_group, category_code, promise_extension)""",
    "boss_categories": """SELECT * FROM (VALUES ('FR', 121, 'Brand#3', 'Yes'), ('IT', 14, 'Brand#4', 'Yes'))
  AS t(country_code, gl_product_group, category_code, boss)""",
    "category_mapping": """SELECT * FROM (VALUES ('Brand#1', 'Children'), ('Brand#1', 'Children'), ('Brand#2', 'WFH Essentials'),
    ('Brand#3', 'Household Care'), ('Brand#4', 'Hygiene/Medical Supplies'), ('Brand#5', 'Grocery'), ('Brand#6', 'Other'))
  AS t(category_desc, semantic_cluster)""",
    "marketplaces": """SELECT * FROM (VALUES (0,'NA','US'), (1,'NA','CA'), (2,'EU','UK'), (3,'EU','DE'), (4,'EU','FR'), (5,'EU','IT'),
    (6,'EU','ES'), (7,'JP','JP'), (8,'IN','IN')) AS t(id, region, country)""",
    "speed_buckets": """SELECT * FROM (VALUES (0, 1, '0-1d'), (2, 3, '2-3d'), (4, 7, '4-7d'), (8, 14, '8-14d'), (15, 29, '15-29d'),
    (30, 999, '30d+')) AS t(range_min, range_max, gvs)""",
    "member_portfolio_sets": """SELECT * FROM (VALUES ('s1','20010501a', DATE '2001-05-02'), ('s2','20010601a', DATE '2001-06-02'),
    ('s3','20010601a', DATE '2001-06-03'), ('s4','20010701pit', DATE '2001-07-02')) AS t(set_id, portfolio_id, portfolio_set_created_time)""",
    "member_snapshot_day_sets": """SELECT * FROM (VALUES ('s5', DATE '2001-06-20', DATE '2001-06-20'), ('s6', DATE '2001-06-21', DATE '2001-06-21'))
  AS t(set_id, snapshot_day, snapshot_day_set_created_time)""",
    "member_sets": f"SELECT * FROM (VALUES {_set_rows()}) AS t(set_id, forecast_date, scenario, run_id)",
}


def _dec(c: Column | str, precision: int, scale: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},{scale})")


def _day(text: str) -> Column:
    return F.lit(dt.date.fromisoformat(text))


#: Order lines that one task joins to their orders, about.
LINES_PER_TASK = 500_000


def _base_sales(t: Tables) -> DataFrame:
    """Order lines with customer and product codes; order lines and orders meet on the order key.

    Orders meet their customers before the lines, which are four times as many, and each side crosses an exchange with its codes alone. Above a few
    tasks' worth of lines the last join has as many tasks as the lines need, so that what a task sorts or sums does not grow with the tables.
    """
    pick = lambda values, index: F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))
    rollup = F.lit("unk")
    for kind, code in reversed(ROLLUPS.items()):
        rollup = F.when(F.col("p_type") == kind, code).otherwise(rollup)
    lines = t["lineitem"].select(
        "l_orderkey", F.col("l_linenumber").alias("line"), "l_partkey", F.when(F.col("l_linestatus") == "O", "ret").otherwise("mkt").alias("channel"),
        F.col("l_shipdate").cast("date").alias("ship_day"), "l_quantity", "l_extendedprice", "l_discount")
    parts = t["part"].select("p_partkey", "p_type", "p_brand")
    goods = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "line", "channel", rollup.alias("gl_rollup"), (F.col("p_partkey") % 16).alias("product"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")).alias("category_code"),
        "ship_day", "l_quantity", "l_extendedprice", "l_discount")
    customers = t["customer"].select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "prm").when(F.col("c_mktsegment") == "MACHINERY", "stu")
        .otherwise("npr").alias("prime_group"))
    orders = (t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day"))
              .join(customers, F.col("o_custkey") == F.col("c_custkey")))
    tasks = t["lineitem"].count() // LINES_PER_TASK
    if tasks > 8:
        goods = goods.repartition(tasks, "l_orderkey")
    price = _dec("l_extendedprice", 12, 2)
    return goods.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_key"), "line", F.col("c_custkey").alias("cust"),
        pick(COUNTRIES, F.col("c_nationkey") % 10).alias("country_code"), "channel", "gl_rollup",
        pick(PRODUCTS, F.col("product")).alias("gl_product_group"), "category_code", "prime_group", "order_day", "ship_day",
        _dec("l_quantity", 12, 2).alias("units"),
        _dec(price * (F.lit(1) - _dec("l_discount", 4, 2)), 18, 4).alias("net"),
        _dec("l_extendedprice", 18, 4).alias("gross"))


def _per_portfolio(df: DataFrame, day: str, modulo: int) -> DataFrame:
    """Each sales row once per portfolio whose forecast it belongs to, with the portfolio as ``p``."""
    entries = [F.struct(F.lit(i).alias("portfolio_id"), _day(d).alias("dataset_date"), F.lit(s).alias("portfolio_status"),
                        F.lit(y).alias("is_latest_publish"), F.lit(f).alias("forecast_id"),
                        F.lit(str(x)).cast("decimal(4,2)").alias("factor"))
               for i, d, s, y, f, x, *_ in PORTFOLIOS]
    earliest = min(d for _, d, *_ in PORTFOLIOS)
    return (df.filter(F.col(day) >= F.date_sub(_day(earliest), FORECAST_REACH))
            .withColumn("p", F.explode(F.array(*entries)))
            .filter((F.col(day) >= F.date_sub("p.dataset_date", FORECAST_REACH))
                    & ((F.col("order_key") + F.col("p.forecast_id")) % modulo != 0)))


def _scaled(c: str, scale: int) -> Column:
    return _dec(F.col(c) * F.col("p.factor"), 18, scale)


def _gl_names(t: Tables) -> DataFrame:
    code = F.col("gl_product_group")
    named = (t["base_sales"].filter(~code.isin(364, 510)).select("gl_product_group").distinct()
             .select(code, F.concat(F.lit("Group "), code.cast("string")).alias("gl_name")))
    return named.union(t.spark.sql("SELECT * FROM (VALUES (14, 'A group'), (364, 'Unknown'), (510, 'Unknown')) AS t(a, b)"))


def _visible_products(t: Tables) -> DataFrame:
    code = F.col("gl_product_group")
    return (t["base_sales"].select("gl_product_group").distinct()
            .select(code, F.concat(F.lit("Shown "), code.cast("string")).alias("gl_name"),
                    F.when(code != 700, code).alias("visible_gl_product_group")))


def _ship_name() -> Column:
    """The facts' own product name: two for one product, 'Unknown' for two, none for one."""
    code = F.col("gl_product_group")
    return (F.when(code.isin(364, 510), "Unknown").when((code == 14) & (F.col("channel") == "mkt"), "A group")
            .when(code != 467, F.concat(F.lit("Group "), code.cast("string"))))


def _usd(amount: Column) -> Column:
    return (amount * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(18,6)")


def _orders_actuals(t: Tables) -> DataFrame:
    return t["base_sales"].select(
        "country_code", "channel", "gl_rollup", "gl_product_group", "category_code", "prime_group", "order_day",
        F.col("units").alias("net_ordered_units"), F.col("net").alias("net_ops"), F.col("gross").alias("net_ordered_gms"))


def _shipment_actuals_all(t: Tables) -> DataFrame:
    """Two datasets; the older one ends earlier."""
    day = F.col("ship_day")
    dates = F.when(day < _day("2001-05-01"), F.array(_day("2001-07-01"), _day("2001-05-01"))).otherwise(F.array(_day("2001-07-01")))
    return t["base_sales"].withColumn("dataset_date", F.explode(dates)).select(
        "country_code", "channel", F.col("channel").alias("subchannel"), "gl_rollup", "gl_product_group", _ship_name().alias("gl_name"),
        "prime_group", "dataset_date", day.alias("target_day"), calendar.week_start(day).alias("target_week"),
        F.trunc(day, "month").alias("target_month"), F.col("units").alias("shipped_units"),
        F.col("net").alias("product_revenue_amt"), F.col("gross").alias("gross_gms_amt"),
        _usd(F.col("net")).alias("product_revenue_usd"), _usd(F.col("gross")).alias("gross_gms_usd"))


def _shipment_actuals(t: Tables) -> DataFrame:
    return t["shipment_actuals_all"].filter(F.col("dataset_date") == _day("2001-07-01"))


def _shipment_forecasts(t: Tables) -> DataFrame:
    event = F.col("line") % 3 == 0
    return _per_portfolio(t["base_sales"], "ship_day", 4).select(
        "p.portfolio_id", "p.portfolio_status", "p.is_latest_publish", "p.dataset_date", "p.forecast_id",
        F.when(event, "promo_event").otherwise("baseline").alias("initiative"),
        F.when(event, "Event").otherwise("Baseline").alias("initiative_type"),
        "country_code", "channel", F.col("channel").alias("subchannel"), "gl_rollup", "gl_product_group", _ship_name().alias("gl_name"),
        "prime_group", F.col("ship_day").alias("target_day"), _scaled("units", 4).alias("shipped_units"),
        _scaled("net", 6).alias("product_revenue_amt"), _scaled("gross", 6).alias("gross_gms_amt"),
        _usd(_scaled("net", 6)).alias("product_revenue_usd"), _usd(_scaled("gross", 6)).alias("gross_gms_usd"))


def _orders_forecast_daily(t: Tables) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(k).alias("forecast_type"), F.lit(o).alias("off")) for k, o in FORECAST_OFFSETS])
    return _per_portfolio(t["base_sales"], "order_day", 5).withColumn("k", F.explode(kinds)).select(
        (F.col("p.forecast_id") + F.col("k.off")).alias("forecast_id"), "k.forecast_type", "p.dataset_date",
        "country_code", "channel", "gl_rollup", "gl_product_group", "prime_group", F.col("order_day").alias("target_day"),
        _scaled("units", 4).alias("net_ordered_units"), _scaled("net", 6).alias("net_ops"),
        _scaled("gross", 6).alias("net_ordered_gms"))


def _confidence_intervals(t: Tables) -> DataFrame:
    sums = t["shipment_forecasts"].groupBy(
        "forecast_id", F.col("dataset_date").alias("forecast_date"), "country_code", "channel", "gl_rollup").agg(
        _dec(F.sum("shipped_units"), 18, 4).alias("shipped_units"), _dec(F.sum("gross_gms_amt"), 20, 4).alias("gms_prv"))
    levels = F.array(*[F.lit(q).cast("decimal(2,1)") for q in QUANTILES])
    q = F.col("quantile")
    return sums.withColumn("quantile", F.explode(levels)).select(
        "forecast_id", "forecast_date", F.lit("2001-06-03").alias("range_start"), F.lit("2001-06-09").alias("range_end"),
        F.lit("week").alias("grain"), "country_code", "channel", F.col("gl_rollup").alias("gl_rollup_code"), "quantile",
        "shipped_units", _dec(F.col("shipped_units") * q, 18, 4).alias("shipped_units_percentile_value"),
        "gms_prv", _dec(F.col("gms_prv") * q, 20, 4).alias("gms_prv_percentile_value"))


def _speed_facts(t: Tables) -> DataFrame:
    market = F.array_position(F.array(*map(F.lit, COUNTRIES)), F.col("country_code")).cast("int") - 1
    speed = ((F.col("order_key") + F.col("gl_product_group")) % 45).cast("int")
    return t["base_sales"].select(
        market.alias("marketplace_id"), F.col("channel").alias("fn_channel"), "gl_product_group", "category_code",
        F.col("category_code").alias("category_desc"), F.col("gl_rollup").alias("wbr_gl_description"),
        F.when(F.col("gl_rollup") == "sft", "Softlines").otherwise("Hardlines").alias("wbr_gl_family"),
        F.when(F.col("line") % 2 == 0, "Y").otherwise("N").alias("in_country"), F.lit("Y").alias("in_region"),
        F.when(F.col("line") != 7, speed).alias("gvs_prod_int"), F.col("units").cast("bigint").alias("gv_count"),
        F.col("order_day").alias("snapshot_day"))


def _segment_forecast(t: Tables) -> DataFrame:
    product = F.col("gl_product_group")
    return t["shipment_forecasts"].select(
        "portfolio_id", F.substring("portfolio_id", 1, 8).alias("forecast_date"), F.lit("Refresh").alias("cs_tag"),
        "initiative", "country_code", F.col("prime_group").alias("customer_group"),
        F.when(F.col("prime_group") == "npr", "npr").when(F.col("channel") == "ret", "paid").otherwise("free").alias("plan_status"),
        F.when(product % 2 == 0, "annual").otherwise("monthly").alias("plan_type"),
        F.when(product % 3 == 0, "1").otherwise("0").alias("tenure"),
        "channel", "subchannel", "gl_rollup", "gl_product_group", "target_day",
        "shipped_units", "product_revenue_amt", "gross_gms_amt")


def _member_actuals(t: Tables) -> DataFrame:
    line = F.col("line")
    grouped = t["base_sales"].groupBy(
        "country_code", F.col("prime_group").alias("customer_group"),
        F.when(F.col("channel") == "ret", "paid").otherwise("free").alias("plan_status"),
        F.when(F.col("cust") % 2 == 0, "annual").otherwise("monthly").alias("plan_type"),
        F.col("order_day").alias("target_day"))
    return grouped.agg((F.count("*") * 100).alias("member_count"), F.sum(line).alias("start_count"),
                       F.count("*").alias("cancel_count"), F.sum(line % 2).alias("convert_in_count"),
                       F.sum(line % 3).alias("convert_out_count")).select(
        "country_code", "customer_group", "plan_status", "plan_type", F.col("target_day").alias("snapshot_day"), "target_day",
        "member_count", "start_count", "cancel_count", "convert_in_count", "convert_out_count")


def _member_runs(t: Tables) -> DataFrame:
    runs = F.array(*[F.lit(r) for *_, r in MEMBER_SETS])
    return (t["member_actuals"].filter(F.col("target_day") >= _day("2000-01-01")).withColumn("run_id", F.explode(runs))
            .select("run_id", "country_code", "customer_group", "plan_status", "plan_type", "target_day",
                    (F.col("member_count") + 10).alias("member_count"), "start_count", "cancel_count",
                    "convert_in_count", "convert_out_count"))


def _member_cohort_runs(t: Tables) -> DataFrame:
    months = F.array(*[_day(m) for m in COHORT_MONTHS])
    return t["member_runs"].withColumn("cohort_month", F.explode(months)).select(
        "run_id", "country_code", "customer_group", "plan_status", "plan_type", "cohort_month", "target_day", "member_count")


def _member_rates(t: Tables) -> DataFrame:
    members = F.col("member_count").cast("double")
    rates = [(F.col(f"{n}_count").cast("double") / members).alias(f"{n}_rate")
             for n in ("cancel", "convert_in", "convert_out", "start")]
    return t["member_runs"].select("run_id", "country_code", "customer_group", "plan_status", "plan_type", "target_day", *rates)


def _member_shock(t: Tables) -> DataFrame:
    shocked = (F.col("country_code") == "US") & (F.col("target_day") >= _day("2000-01-01"))
    return t["member_actuals"].filter(shocked).select(
        "country_code", "customer_group", "plan_status", "plan_type", "target_day",
        F.floor(F.col("member_count") / 100).cast("bigint").alias("member_count"))


def _forecast_metadata(t: Tables) -> DataFrame:
    kind = F.col("forecast_id") % 3
    text = (F.when(kind == 0, "run [IN,INT,WW]").when(kind == 1, "run [CA,DE,ES,EU,FR,INT,IT,JP,NA,UK,US,WW]")
            .otherwise("run [MX]"))
    return t["portfolio_metadata"].select(
        "forecast_id", "dataset_date", F.lit("confidence_intervals").alias("forecast_type"),
        F.col("portfolio_status").alias("forecast_status"), text.alias("forecast_description"))


_DERIVED = {
    "base_sales": _base_sales, "gl_names": _gl_names, "visible_products": _visible_products, "forecast_metadata": _forecast_metadata,
    "forecast_portfolios": lambda t: t["portfolio_metadata"].select("forecast_id", "portfolio_id"),
    "orders_actuals": _orders_actuals, "shipment_actuals": _shipment_actuals, "shipment_actuals_all": _shipment_actuals_all, "shipment_forecasts": _shipment_forecasts,
    "orders_forecast_daily": _orders_forecast_daily,
    "orders_forecast_adjusted": lambda t: t["orders_forecast_daily"].filter(F.col("forecast_type") == "Adjusted"),
    "confidence_intervals": _confidence_intervals, "speed_facts": _speed_facts, "segment_forecast": _segment_forecast,
    "member_actuals": _member_actuals, "member_runs": _member_runs, "member_cohort_runs": _member_cohort_runs,
    "member_rates": _member_rates, "member_shock": _member_shock,
}
_RAW = ("lineitem", "orders", "customer", "part")


def sample_tables(spark: SparkSession, sf_dir: str) -> Tables:
    makers = {n: (lambda t, n=n: t.spark.read.parquet(f"{sf_dir}/{n}.parquet")) for n in _RAW}
    makers.update({n: (lambda t, s=s: t.spark.sql(s)) for n, s in LITERALS.items()})
    makers.update(_DERIVED)
    return Tables(spark, makers)
