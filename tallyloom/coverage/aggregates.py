"""Aggregations, ranks, top-N, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.coverage.registry import case, dbl
from tallyloom.coverage.tables_and_columns import FX, num, rates
from tallyloom.functions import calendar, measures
from tallyloom.functions.labels import member_class
from tallyloom.operators.distinct import counts_of, dense_texts, partial_bitmaps
from tallyloom.operators.grains import multi_grain
from tallyloom.operators.joins import rates_of, with_rate
from tallyloom.operators.partials import DayPartials
from tallyloom.operators.selection import largest, latest_id_per, newest, newest_rows, ranked, ranked_globally, top_ranked
from tallyloom.operators.staging import stage
from tallyloom.plans import category_yoy
from tallyloom.plans.common import canonical_names, order_revenue
from tallyloom.session import new_folder

PERIODS = """CASE grain WHEN 'Weekly' THEN target_day - CAST(dayofweek(target_day) AS INTEGER)
    WHEN 'Monthly' THEN CAST(date_trunc('month', target_day) AS DATE)
    WHEN 'Quarterly' THEN CAST(date_trunc('quarter', target_day) AS DATE) ELSE CAST(date_trunc('year', target_day) AS DATE) END"""
GRAINS = "(VALUES ('Weekly'), ('Monthly'), ('Quarterly'), ('Yearly')) AS g(grain)"


# --- aggregations -----------------------------------------------------------------------------------------------------

@case("agg_sum", f"""SELECT country_code, gl_rollup, {dbl("sum(shipped_units)")} AS units, {dbl("sum(gross_gms_amt)")} AS gms FROM shipment_actuals GROUP BY ALL""")
def agg_sum(t):
    return t["shipment_actuals"].groupBy("country_code", "gl_rollup").agg(
        num(F.sum("shipped_units")).alias("units"), num(F.sum("gross_gms_amt")).alias("gms"))


@case("agg_sum_case", f"""SELECT order_day, {dbl("sum(net_ops * fx_rate) FILTER (channel = 'ret')")} AS retail, {dbl("sum(net_ordered_gms * fx_rate) FILTER (channel <> 'ret')")} AS other
FROM orders_actuals JOIN {FX} USING (country_code) GROUP BY ALL""")
def agg_sum_case(t):
    retail, revenue = F.col("channel") == measures.RETAIL, measures.converted(order_revenue())
    return with_rate(t["orders_actuals"], rates(t)).groupBy("order_day").agg(
        num(F.sum(F.when(retail, revenue))).alias("retail"), num(F.sum(F.when(~retail, revenue))).alias("other"))


@case("agg_sum_product_capped", """SELECT marketplace_id, snapshot_day, CAST(sum(gv_count * if(gvs_prod_int < 35, gvs_prod_int, 35)) AS BIGINT) AS gvs_prod_sum
FROM speed_facts GROUP BY ALL""")
def agg_sum_product_capped(t):
    weighted = F.col("gv_count") * F.least("gvs_prod_int", F.lit(35))
    return t["speed_facts"].groupBy("marketplace_id", "snapshot_day").agg(F.sum(weighted).alias("gvs_prod_sum"))


@case("agg_max", """SELECT country_code, max(order_day) AS last_day, max(category_code) AS last_category FROM orders_actuals GROUP BY ALL""")
def agg_max(t):
    # one row per country and category first: a maximum of texts needs sorted input, which should be short
    kinds = t["orders_actuals"].groupBy("country_code", "category_code").agg(F.max("order_day").alias("last_day"))
    return kinds.groupBy("country_code").agg(F.max("last_day").alias("last_day"), F.max("category_code").alias("last_category"))


@case("agg_min", """SELECT channel, min(last_day) AS first_of_last FROM (
  SELECT channel, country_code, max(order_day) AS last_day FROM orders_actuals GROUP BY ALL) GROUP BY ALL""")
def agg_min(t):
    last = t["orders_actuals"].groupBy("channel", "country_code").agg(F.max("order_day").alias("last_day"))
    return last.groupBy("channel").agg(F.min("last_day").alias("first_of_last"))


@case("agg_global_max", "SELECT max(target_day) AS target_day FROM shipment_actuals WHERE dayofweek(target_day) = 6")
def agg_global_max(t):
    return t.versions("shipment_actuals").filter(calendar.weekday(F.col("target_day")) == 6).agg(F.max("target_day").alias("target_day"))


@case("agg_min_of_max", """WITH ends AS (SELECT country_code, max(order_day) AS last_day FROM orders_actuals GROUP BY ALL)
SELECT 'NA' AS country_code, min(last_day) AS max_order_day FROM ends WHERE country_code IN ('US', 'CA') HAVING count(*) > 0
UNION SELECT 'EU', min(last_day) FROM ends WHERE country_code IN ('UK', 'DE', 'FR', 'IT', 'ES') HAVING count(*) > 0
UNION FROM ends""")
def agg_min_of_max(t):
    return category_yoy.last_days_with_regions(t.versions("orders_actuals"))


@case("agg_count_distinct", """SELECT country_code, customer_group, count(DISTINCT tenure) AS tenures, count(DISTINCT target_day) AS days FROM segment_forecast GROUP BY ALL""")
def agg_count_distinct(t):
    rows, keys = t["segment_forecast"], ["country_code", "customer_group"]
    coded = rows.select(*keys, "tenure", "target_day").join(dense_texts(rows, "tenure"), "tenure", "left")
    codes = {"tenures": F.col("code"), "days": F.datediff("target_day", F.lit("1970-01-01").cast("date")).cast("long")}
    return counts_of(partial_bitmaps(coded, keys, codes), keys, list(codes))


@case("agg_avg", """SELECT country_code, round(avg(day(last_day(target_day))), 6) AS days_in_month, round(avg(member_count), 6) AS members FROM member_actuals GROUP BY ALL""")
def agg_avg(t):
    return t["member_actuals"].groupBy("country_code").agg(
        F.round(F.avg(calendar.days_in_month(F.col("target_day"))), 6).alias("days_in_month"),
        F.round(F.avg("member_count"), 6).alias("members"))


@case("agg_average_balance", """SELECT country_code, CAST(date_trunc('month', target_day) AS DATE) AS target_month,
  round(CAST(sum(a.member_count - coalesce(s.member_count, 0)) AS DOUBLE) / avg(day(last_day(target_day))), 6) AS avg_members
FROM member_actuals a LEFT JOIN member_shock s USING (country_code, customer_group, plan_status, plan_type, target_day) GROUP BY ALL""")
def agg_average_balance(t):
    shock = t["member_shock"].withColumnRenamed("member_count", "shock")
    joined = t["member_actuals"].join(shock, ["country_code", "customer_group", "plan_status", "plan_type", "target_day"], "left")
    held = F.col("member_count") - F.coalesce("shock", F.lit(0))
    return joined.groupBy("country_code", F.trunc("target_day", "month").alias("target_month")).agg(
        measures.per_day(F.sum(held), F.avg(calendar.days_in_month(F.col("target_day")))).alias("avg_members"))


@case("agg_distinct_rows", "SELECT portfolio_id, dataset_date, target_day FROM shipment_forecasts GROUP BY ALL")
def agg_distinct_rows(t):
    return t["shipment_forecasts"].select("portfolio_id", "dataset_date", "target_day").distinct()


@case("agg_distinct_over_group", """SELECT DISTINCT dataset_date, max(portfolio_id) AS portfolio_id FROM shipment_forecasts
WHERE portfolio_status = 'PRODUCTION' GROUP BY 1""")
def agg_distinct_over_group(t):
    return latest_id_per(t["shipment_forecasts"].filter(F.col("portfolio_status") == "PRODUCTION"), "dataset_date", "portfolio_id")


@case("agg_latest_id_per_date", """SELECT forecast_type, dataset_date, max(forecast_id) AS forecast_id FROM orders_forecast_daily GROUP BY ALL""")
def agg_latest_id_per_date(t):
    return latest_id_per(t["orders_forecast_daily"], ["forecast_type", "dataset_date"], "forecast_id")


@case("agg_canonical_name", """SELECT gl_product_group, max(gl_name) AS gl_name FROM gl_names WHERE gl_name <> 'Unknown' GROUP BY ALL""")
def agg_canonical_name(t):
    return canonical_names(t["gl_names"])


@case("agg_group_by_expr", """SELECT 'Orders' AS data_stream, if(prime_group = 'npr', 'npr', 'prm') AS prime_group,
  CAST(month(order_day) AS INTEGER) AS month_number, count(*) AS lines FROM orders_actuals GROUP BY 1, 2, 3""")
def agg_group_by_expr(t):
    return t["orders_actuals"].groupBy(
        F.lit("Orders").alias("data_stream"), member_class(F.col("prime_group")).alias("prime_group"),
        F.month("order_day").alias("month_number")).agg(F.count("*").alias("lines"))


@case("agg_multi_grain", f"""SELECT grain AS date_granularity, country_code, customer_group, {PERIODS} AS target_day,
  CAST(sum(member_count) AS BIGINT) AS members, count(DISTINCT target_day) AS days_in_period FROM member_actuals, {GRAINS} GROUP BY ALL""")
def agg_multi_grain(t):
    # stored partials: the days up to a first refresh, then only those that came since
    keys, sums = ["country_code", "customer_group"], {"members": F.col("member_count")}
    partials = DayPartials(t, "member_actuals", new_folder(t.spark, "daily-members"), keys, sums)
    days = [r[0] for r in t.versions("member_actuals").select("target_day").distinct().collect()]
    partials.refresh(sorted(days)[:-7])
    partials.refresh(days)
    return multi_grain(partials.frame(), "target_day", keys, {"members": F.col("members")}, distinct_days="days_in_period")


@case("agg_two_level", f"""SELECT country_code, CAST(date_trunc('quarter', target_day) AS DATE) AS target_quarter, {dbl("max(units)")} AS best_day, {dbl("sum(units)")} AS units
FROM (SELECT country_code, target_day, sum(shipped_units) AS units FROM shipment_actuals GROUP BY ALL) GROUP BY ALL""")
def agg_two_level(t):
    daily = t["shipment_actuals"].groupBy("country_code", "target_day").agg(F.sum("shipped_units").alias("units"))
    return daily.groupBy("country_code", F.trunc("target_day", "quarter").alias("target_quarter")).agg(
        num(F.max("units")).alias("best_day"), num(F.sum("units")).alias("units"))


@case("agg_freshness", """SELECT 'Shipments' AS data_stream, country_code, max(target_day) AS latest_act FROM (
  SELECT country_code, gl_product_group, target_day, sum(shipped_units) AS u FROM shipment_actuals GROUP BY ALL) GROUP BY ALL
UNION SELECT 'Orders', country_code, max(order_day) FROM orders_actuals GROUP BY ALL""")
def agg_freshness(t):
    def last(rows, name, day):
        return rows.groupBy("country_code").agg(F.max(day).alias("latest_act")).select(
            F.lit(name).alias("data_stream"), "country_code", "latest_act")
    return last(t.versions("shipment_actuals"), "Shipments", "target_day").union(last(t.versions("orders_actuals"), "Orders", "order_day"))


# --- ranks, top-N, sorts ----------------------------------------------------------------------------------------------

@case("rank_partitioned", """SELECT forecast_type, dataset_date, forecast_id, CAST(rank() OVER (PARTITION BY forecast_type
  ORDER BY dataset_date DESC NULLS LAST) AS INTEGER) AS forecast_rank FROM (SELECT DISTINCT forecast_type, dataset_date, forecast_id FROM orders_forecast_daily)""")
def rank_partitioned(t):
    versions = t["orders_forecast_daily"].select("forecast_type", "dataset_date", "forecast_id").distinct()
    return ranked(versions, newest("dataset_date"), ["forecast_type"], "forecast_rank")


@case("rank_global", """SELECT portfolio_id, dataset_date, CAST(rank() OVER (ORDER BY dataset_date DESC NULLS LAST) AS INTEGER) AS portfolio_rank
FROM (SELECT DISTINCT portfolio_id, dataset_date FROM shipment_forecasts)""")
def rank_global(t):
    return ranked_globally(t["shipment_forecasts"].select("portfolio_id", "dataset_date").distinct(), {"dataset_date": True}, "portfolio_rank")


@case("rank_global_tiebreak", """SELECT portfolio_id, dataset_date, CAST(row_number() OVER (ORDER BY dataset_date DESC NULLS LAST, portfolio_id DESC) AS INTEGER) AS portfolio_rank
FROM (SELECT DISTINCT portfolio_id, dataset_date FROM shipment_forecasts)""")
def rank_global_tiebreak(t):
    listed = t["shipment_forecasts"].select("portfolio_id", "dataset_date").distinct()
    return ranked_globally(listed, {"dataset_date": True, "portfolio_id": True}, "portfolio_rank")


@case("topk_by_rank", """SELECT country_code, order_day FROM (SELECT DISTINCT country_code, order_day FROM orders_actuals)
QUALIFY dense_rank() OVER (PARTITION BY country_code ORDER BY order_day DESC NULLS LAST) <= 5""")
def topk_by_rank(t):
    days = t["orders_actuals"].select("country_code", "order_day").distinct()
    return top_ranked(days, 5, newest("order_day"), ["country_code"]).drop("rank")


@case("rank_as_output", f"""WITH listed AS (SELECT portfolio_id, portfolio_status, CAST(rank() OVER (PARTITION BY portfolio_status ORDER BY dataset_date DESC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT DISTINCT portfolio_id, portfolio_status, dataset_date FROM shipment_forecasts))
SELECT rank, portfolio_id, {dbl("sum(shipped_units)")} AS units FROM shipment_forecasts JOIN listed USING (portfolio_id, portfolio_status)
WHERE portfolio_status IN ('PRODUCTION', 'DRAFT') AND (rank = 1 OR portfolio_status = 'PRODUCTION') GROUP BY ALL""")
def rank_as_output(t):
    facts = t["shipment_forecasts"]
    listed = ranked(facts.select("portfolio_id", "portfolio_status", "dataset_date").distinct(), newest("dataset_date"), ["portfolio_status"])
    status, rank = F.col("portfolio_status"), F.col("rank")
    kept = listed.filter((status.isin("PRODUCTION", "DRAFT") & (rank == 1)) | ((status == "PRODUCTION") & (rank > 1)))
    chosen = stage(kept.select("portfolio_id", "rank"), "portfolios")
    return facts.join(chosen, "portfolio_id").groupBy("rank", "portfolio_id").agg(num(F.sum("shipped_units")).alias("units"))


@case("topk_order_limit", """SELECT portfolio_id, dataset_date FROM (SELECT DISTINCT portfolio_id, dataset_date FROM shipment_forecasts)
ORDER BY dataset_date DESC NULLS LAST, portfolio_id DESC LIMIT 3""")
def topk_order_limit(t):
    return newest_rows(t["shipment_forecasts"].select("portfolio_id", "dataset_date").distinct(), 3, "dataset_date", "portfolio_id")


@case("sort_ordinals", f"""SELECT country_code, channel, gl_rollup, gl_product_group, prime_group, order_day, {dbl("sum(net_ordered_units)")} AS units
FROM orders_actuals GROUP BY ALL ORDER BY 1, 2, 3, 4, 5, 6""")
def sort_ordinals(t):
    keys = ["country_code", "channel", "gl_rollup", "gl_product_group", "prime_group", "order_day"]
    return t["orders_actuals"].groupBy(*keys).agg(num(F.sum("net_ordered_units")).alias("units")).orderBy(*keys)


@case("limit_scalar", f"""SELECT country_code, {dbl("sum(net_ops * fx_rate)")} AS prv_usd FROM orders_actuals JOIN fx_rates ON source_country_code = country_code
WHERE target_country_code = 'US' AND scenario = (SELECT DISTINCT fx_scenario FROM dataset_reference LIMIT 1) GROUP BY ALL""")
def limit_scalar(t):
    current = rates_of(t["fx_rates"], largest(t["dataset_reference"], "fx_scenario"))
    return (with_rate(t["orders_actuals"], current).groupBy("country_code")
            .agg(num(F.sum(measures.converted(F.col("net_ops")))).alias("prv_usd")))


# --- set operations ---------------------------------------------------------------------------------------------------

@case("union_all", f"""SELECT 'final' AS scenario, portfolio_id, target_day, {dbl("sum(shipped_units)")} AS units FROM segment_forecast GROUP BY ALL
UNION ALL SELECT 'system', portfolio_id, target_day, {dbl("sum(shipped_units)")} FROM segment_forecast WHERE initiative = 'baseline' GROUP BY ALL""")
def union_all(t):
    def part(rows, name):
        return rows.groupBy(F.lit(name).alias("scenario"), "portfolio_id", "target_day").agg(num(F.sum("shipped_units")).alias("units"))
    rows = t["segment_forecast"]
    return part(rows, "final").union(part(rows.filter(F.col("initiative") == "baseline"), "system"))


@case("union_distinct", """SELECT country_code, channel, order_day AS day FROM orders_actuals
UNION SELECT country_code, channel, target_day FROM shipment_actuals UNION SELECT country_code, channel, target_day FROM shipment_forecasts""")
def union_distinct(t):
    orders = t["orders_actuals"].select("country_code", "channel", F.col("order_day").alias("day"))
    shipments = t["shipment_actuals"].select("country_code", "channel", "target_day")
    return orders.union(shipments).union(t["shipment_forecasts"].select("country_code", "channel", "target_day")).distinct()


@case("union_heterogeneous", f"""SELECT 'Orders' AS data_stream, CAST(NULL AS DATE) AS dataset_date, country_code, '' AS subchannel, order_day AS target_day,
  {dbl("sum(net_ordered_units)")} AS units FROM orders_actuals GROUP BY ALL
UNION SELECT 'Shipments', dataset_date, country_code, subchannel, target_day, {dbl("sum(shipped_units)")} FROM shipment_forecasts GROUP BY ALL""")
def union_heterogeneous(t):
    orders = t["orders_actuals"].groupBy("country_code", "order_day").agg(num(F.sum("net_ordered_units")).alias("units")).select(
        F.lit("Orders").alias("data_stream"), F.lit(None).cast("date").alias("dataset_date"), "country_code",
        F.lit("").alias("subchannel"), F.col("order_day").alias("target_day"), "units")
    planned = t["shipment_forecasts"].groupBy("dataset_date", "country_code", "subchannel", "target_day").agg(
        num(F.sum("shipped_units")).alias("units")).select(
        F.lit("Shipments"), "dataset_date", "country_code", "subchannel", "target_day", "units")
    return orders.union(planned)
