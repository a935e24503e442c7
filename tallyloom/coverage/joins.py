"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.coverage.registry import case, dbl
from tallyloom.coverage.tables_and_columns import ALL_MODES, FX, RECENT, num, rates
from tallyloom.functions import measures
from tallyloom.operators.joins import beside_prior_year, full_pair, range_join, rates_of, specific_or_default, wildcard_left, with_rate
from tallyloom.operators.selection import latest_id_per, only_value, with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans import member_comparison
from tallyloom.plans.common import latest_sets

KEYS = ["country_code", "channel", "gl_rollup", "gl_product_group"]


@case("join_inner_on", """SELECT m.country, f.fn_channel, CAST(sum(gv_count) AS BIGINT) AS views
FROM speed_facts f, marketplaces m WHERE m.id = f.marketplace_id GROUP BY ALL""")
def join_inner_on(t):
    facts, markets = t["speed_facts"], t["marketplaces"]
    return (facts.join(markets, facts["marketplace_id"] == markets["id"]).groupBy("country", "fn_channel")
            .agg(F.sum("gv_count").alias("views")))


@case("join_inner_using", f"""SELECT country_code, channel, gl_rollup, gl_product_group, day AS target_day, {dbl("p")} AS units_fcst, {dbl("s")} AS units_act
FROM (SELECT country_code, channel, gl_rollup, gl_product_group, target_day AS day, sum(net_ordered_units) AS p FROM orders_forecast_adjusted GROUP BY ALL)
NATURAL JOIN (SELECT country_code, channel, gl_rollup, gl_product_group, order_day AS day, sum(net_ordered_units) AS s FROM orders_actuals GROUP BY ALL)""")
def join_inner_using(t):
    planned = (t["orders_forecast_adjusted"].groupBy(*KEYS, "target_day")
               .agg(num(F.sum("net_ordered_units")).alias("units_fcst")))
    sold = (t["orders_actuals"].withColumnRenamed("order_day", "target_day").groupBy(*KEYS, "target_day")
            .agg(num(F.sum("net_ordered_units")).alias("units_act")))
    return planned.join(sold, [*KEYS, "target_day"])


@case("join_left_on", """SELECT run_id, country_code, customer_group, plan_status, plan_type, target_day, member_count, cancel_rate
FROM member_runs LEFT JOIN (SELECT run_id, country_code, customer_group, plan_status, plan_type, target_day, cancel_rate
  FROM member_rates WHERE cancel_rate > 0.008) USING (run_id, country_code, customer_group, plan_status, plan_type, target_day)""")
def join_left_on(t):
    keys = ["run_id", "country_code", "customer_group", "plan_status", "plan_type", "target_day"]
    runs = t["member_runs"].alias("r")
    found = t["member_rates"].alias("x")
    same = F.col("x.cancel_rate") > 0.008  # a condition on the right side alone: rows of the left stay
    for k in keys:
        same = same & (F.col(f"r.{k}") == F.col(f"x.{k}"))
    return runs.join(found, same, "left").select(*[F.col(f"r.{k}") for k in keys], "r.member_count", "x.cancel_rate")


@case("join_left_using", """SELECT country_code, customer_group, plan_status, plan_type, target_day, a.member_count, s.member_count AS shock
FROM member_actuals a LEFT JOIN member_shock s USING (country_code, customer_group, plan_status, plan_type, target_day)""")
def join_left_using(t):
    keys = ["country_code", "customer_group", "plan_status", "plan_type", "target_day"]
    shock = t["member_shock"].withColumnRenamed("member_count", "shock")
    return t["member_actuals"].join(shock, keys, "left").select(*keys, "member_count", "shock")


@case("join_full_using", f"""WITH f AS (SELECT country_code, gl_product_group, gl_name, target_day, sum(shipped_units) AS u FROM shipment_forecasts GROUP BY ALL),
a AS (SELECT country_code, gl_product_group, gl_name, target_day, sum(shipped_units) AS u FROM shipment_actuals GROUP BY ALL)
SELECT country_code, gl_product_group, gl_name, target_day, {dbl("f.u")} AS units_fcst, {dbl("a.u")} AS units_act
FROM f FULL OUTER JOIN a USING (country_code, gl_product_group, gl_name, target_day)""")
def join_full_using(t):
    keys = ["country_code", "gl_product_group", "gl_name", "target_day"]

    def summed(rows, name):
        return rows.groupBy(*keys).agg(num(F.sum("shipped_units")).alias(name))

    return full_pair(summed(t["shipment_forecasts"], "units_fcst"), summed(t["shipment_actuals"], "units_act"), keys)


@case("join_fx_rate", f"""SELECT country_code, order_day, {dbl("sum(net_ordered_gms * fx_rate)")} AS gms_usd
FROM orders_actuals JOIN fx_rates ON source_country_code = country_code AND scenario = '2001 PLAN' AND target_country_code = 'US' GROUP BY ALL""")
def join_fx_rate(t):
    priced = with_rate(t["orders_actuals"], rates(t))
    return priced.groupBy("country_code", "order_day").agg(num(F.sum(measures.converted(F.col("net_ordered_gms")))).alias("gms_usd"))


@case("join_semi_in", f"""SELECT dataset_date, forecast_id, {dbl("sum(net_ordered_units)")} AS units FROM orders_forecast_daily
WHERE forecast_type = 'Adjusted' AND forecast_id IN (SELECT max(forecast_id) FROM orders_forecast_daily WHERE forecast_type = 'Adjusted' GROUP BY dataset_date)
GROUP BY ALL""")
def join_semi_in(t):
    adjusted = t["orders_forecast_daily"].filter(F.col("forecast_type") == "Adjusted")
    versions = t.versions("orders_forecast_daily").filter(F.col("forecast_type") == "Adjusted")
    ids = stage(latest_id_per(versions, "dataset_date", "forecast_id").select("forecast_id").distinct(), "forecast-ids")
    return (with_ids(adjusted, ids, "forecast_id", how="left_semi").groupBy("dataset_date", "forecast_id")
            .agg(num(F.sum("net_ordered_units")).alias("units")))


@case("filter_scalar_subquery", f"""SELECT country_code, {dbl("sum(net_ops * fx_rate)")} AS prv_usd FROM orders_actuals
JOIN (SELECT source_country_code AS country_code, fx_rate FROM fx_rates SEMI JOIN fx_scenario USING (scenario) WHERE target_country_code = 'US') USING (country_code)
GROUP BY ALL""")
def filter_scalar_subquery(t):
    current = rates_of(t["fx_rates"], only_value(t["fx_scenario"], "scenario"))
    return (with_rate(t["orders_actuals"], current).groupBy("country_code")
            .agg(num(F.sum(measures.converted(F.col("net_ops")))).alias("prv_usd")))


@case("join_range_bucket", """SELECT gvs, snapshot_day, CAST(sum(gv_count) AS BIGINT) AS views
FROM speed_facts JOIN speed_buckets ON ifnull(gvs_prod_int, 30) BETWEEN range_min AND range_max GROUP BY gvs, snapshot_day""")
def join_range_bucket(t):
    speed = F.coalesce("gvs_prod_int", F.lit(30))
    return (range_join(t["speed_facts"], t["speed_buckets"], speed, "range_min", "range_max").groupBy("gvs", "snapshot_day")
            .agg(F.sum("gv_count").alias("views")))


@case("join_wildcard_key", """SELECT o.country_code, o.gl_product_group, o.category_code, e.promise_extension, count(*) AS lines FROM orders_actuals o
LEFT JOIN promise_extension e ON e.country_code = o.country_code AND e.gl_product_group = o.gl_product_group
  AND coalesce(e.category_code, o.category_code) = o.category_code GROUP BY ALL""")
def join_wildcard_key(t):
    found = wildcard_left(t["orders_actuals"], t["promise_extension"], ("country_code", "gl_product_group"), "category_code", ["promise_extension"])
    return found.groupBy("country_code", "gl_product_group", "category_code", "promise_extension").agg(F.count("*").alias("lines"))


@case("join_default_fallback", """WITH hit AS (
  SELECT o.country_code, o.order_day, e.promise_extension AS own FROM orders_actuals o
  LEFT JOIN promise_extension e ON e.country_code = o.country_code AND e.gl_product_group = o.gl_product_group
    AND coalesce(e.category_code, o.category_code) = o.category_code)
SELECT country_code, order_day, coalesce(own, fallback, 'Extension_None') AS promise_extension, count(*) AS lines
FROM hit LEFT JOIN (SELECT country_code, promise_extension AS fallback FROM promise_extension WHERE gl_product_group = 0) USING (country_code) GROUP BY ALL""")
def join_default_fallback(t):
    return (specific_or_default(t["orders_actuals"], t["promise_extension"], "promise_extension", otherwise="Extension_None")
            .groupBy("country_code", "order_day", "promise_extension").agg(F.count("*").alias("lines")))


@case("join_prior_year_aligned", f"""WITH daily AS (SELECT country_code, channel, order_day, isoyear(order_day + 1) AS y, week(order_day + 1) AS w,
    dayofweek(order_day) AS dow, sum(net_ordered_units) AS u FROM orders_actuals GROUP BY ALL)
SELECT c.country_code, c.channel, c.order_day AS target_day, CAST(c.y AS INTEGER) AS year, CAST(c.w AS INTEGER) AS week, CAST(c.dow AS INTEGER) AS dow,
  {dbl("c.u")} AS units_cy, {dbl("p.u")} AS units_py
FROM daily c LEFT JOIN daily p ON p.country_code = c.country_code AND p.channel = c.channel AND p.y = c.y - 1 AND p.w = c.w AND p.dow = c.dow""")
def join_prior_year_aligned(t):
    everything = F.col("order_day").isNotNull()
    paired = beside_prior_year(t["orders_actuals"], "order_day", ("country_code", "channel"), {"units": F.col("net_ordered_units")},
                               current=everything, prior=everything)
    return paired.withColumns({c: num(F.col(c)) for c in ("units_cy", "units_py")})


@case("join_latest_version", """SELECT portfolio_id, run_id, scenario, CAST(sum(member_count) AS BIGINT) AS members
FROM member_runs JOIN member_sets USING (run_id) JOIN (SELECT portfolio_id, arg_max(set_id, portfolio_set_created_time) AS set_id
  FROM member_portfolio_sets GROUP BY ALL) USING (set_id) GROUP BY ALL""")
def join_latest_version(t):
    runs = t["member_sets"].join(latest_sets(t["member_portfolio_sets"]), "set_id").select("portfolio_id", "run_id", "scenario")
    return (with_ids(t["member_runs"], stage(runs, "member-runs"), "run_id").groupBy("portfolio_id", "run_id", "scenario")
            .agg(F.sum("member_count").alias("members")))


@case("join_recent_portfolios", f"""WITH {RECENT.format(modes=ALL_MODES)}
SELECT portfolio_id, target_day, {dbl("sum(shipped_units)")} AS units FROM shipment_forecasts JOIN ids USING (portfolio_id) GROUP BY ALL""")
def join_recent_portfolios(t):
    ids = stage(member_comparison.portfolios(t, member_comparison.INTERNAL, "2001-01-01"), "portfolios")
    return (with_ids(t["shipment_forecasts"], ids, "portfolio_id").groupBy("portfolio_id", "target_day")
            .agg(num(F.sum("shipped_units")).alias("units")))


@case("join_visible_products", f"""SELECT gl_product_group, gl_name, {dbl("sum(net_ordered_units)")} AS units FROM orders_actuals
JOIN visible_products USING (gl_product_group) WHERE visible_gl_product_group IS NOT NULL GROUP BY ALL""")
def join_visible_products(t):
    visible = t["visible_products"].filter(F.col("visible_gl_product_group").isNotNull()).select("gl_product_group", "gl_name")
    # sums per product first: the names repeat a product, and only a few rows are left to repeat
    sums = t["orders_actuals"].groupBy("gl_product_group").agg(num(F.sum("net_ordered_units")).alias("units"))
    return sums.join(visible, "gl_product_group").select("gl_product_group", "gl_name", "units")


@case("join_latest_actual_date", """WITH ends AS (
  SELECT 'Shipments' AS ship_order, country_code, max(target_day) AS latest_act FROM shipment_actuals GROUP BY ALL
  UNION SELECT 'Orders', country_code, max(order_day) FROM orders_actuals GROUP BY ALL)
SELECT ship_order, country_code, latest_act, count(*) AS lines FROM (
  SELECT 'Shipments' AS ship_order, country_code FROM shipment_forecasts UNION ALL SELECT 'Orders', country_code FROM orders_forecast_adjusted)
LEFT JOIN ends USING (ship_order, country_code) GROUP BY ALL""")
def join_latest_actual_date(t):
    def fresh(name, forecast, actual, day):
        last = t.versions(actual).groupBy("country_code").agg(F.max(day).alias("latest_act"))
        lines = forecast.groupBy("country_code").agg(F.count("*").alias("lines"))
        return (lines.join(last, "country_code", "left")
                .select(F.lit(name).alias("ship_order"), "country_code", "latest_act", "lines"))
    return (fresh("Shipments", t["shipment_forecasts"], "shipment_actuals", "target_day")
            .union(fresh("Orders", t["orders_forecast_adjusted"], "orders_actuals", "order_day")))
