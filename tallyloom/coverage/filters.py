"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.coverage.registry import case, dbl
from tallyloom.coverage.sample_params import AS_OF
from tallyloom.coverage.tables_and_columns import RECENT, num
from tallyloom.functions import calendar, labels
from tallyloom.operators.selection import with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans import category_yoy, daily_impact, member_comparison


@case("filter_compare", """SELECT portfolio_id, gl_product_group, count(*) AS lines FROM shipment_forecasts
WHERE gl_product_group < 991 AND forecast_id <> 5299 AND target_day >= DATE '2001-01-01' GROUP BY ALL""")
def filter_compare(t):
    rows = t["shipment_forecasts"].filter((F.col("gl_product_group") < 991) & (F.col("forecast_id") != 5299)
                                          & (F.col("target_day") >= F.lit("2001-01-01").cast("date")))
    return rows.groupBy("portfolio_id", "gl_product_group").agg(F.count("*").alias("lines"))


@case("filter_in_list", """SELECT country_code, order_day, count(*) AS lines FROM orders_actuals
WHERE list_contains(['US', 'CA', 'UK', 'DE', 'FR', 'IT', 'ES'], country_code) GROUP BY ALL""")
def filter_in_list(t):
    return (t["orders_actuals"].filter(F.col("country_code").isin(*labels.YOY_COUNTRIES)).groupBy("country_code", "order_day")
            .agg(F.count("*").alias("lines")))


@case("filter_not_in_list", """SELECT category_code, gl_rollup, count(*) AS lines FROM orders_actuals
WHERE gl_rollup NOT IN ('dig', 'unk') AND category_code NOT IN ('Brand#1', 'Brand#2') GROUP BY ALL""")
def filter_not_in_list(t):
    rows = t["orders_actuals"].filter(~F.col("gl_rollup").isin(*labels.SKIPPED_ROLLUPS) & ~F.col("category_code").isin("Brand#1", "Brand#2"))
    return rows.groupBy("category_code", "gl_rollup").agg(F.count("*").alias("lines"))


@case("filter_between", """SELECT order_day, count(*) AS lines FROM orders_actuals
WHERE order_day >= DATE '2000-01-02' AND order_day <= DATE '2000-07-02' GROUP BY ALL""")
def filter_between(t):
    return (t["orders_actuals"].filter(calendar.within(F.col("order_day"), "2000-01-02", "2000-07-02")).groupBy("order_day")
            .agg(F.count("*").alias("lines")))


@case("filter_like", f"""SELECT portfolio_id, {dbl("sum(shipped_units)")} AS units FROM shipment_forecasts
WHERE (portfolio_id LIKE '%a' OR portfolio_id LIKE '%b') AND portfolio_id NOT LIKE '%pit%' AND portfolio_id NOT LIKE '%bit%' GROUP BY ALL""")
def filter_like(t):
    return (t["shipment_forecasts"].filter(labels.published_id(F.col("portfolio_id"))).groupBy("portfolio_id")
            .agg(num(F.sum("shipped_units")).alias("units")))


@case("filter_is_not_null", """SELECT country_code, count(*) AS lines, count(DISTINCT category_code) AS categories FROM orders_actuals
WHERE category_code IS NOT NULL GROUP BY ALL""")
def filter_is_not_null(t):
    return (t["orders_actuals"].filter(F.col("category_code").isNotNull()).groupBy("country_code")
            .agg(F.count("*").alias("lines"), F.countDistinct("category_code").alias("categories")))


@case("filter_compound_or", """SELECT country_code, forecast_id, count(*) AS lines FROM orders_forecast_adjusted
WHERE (country_code = 'JP' AND forecast_id = 5005) OR (country_code <> 'JP' AND forecast_id = 5006) GROUP BY ALL""")
def filter_compound_or(t):
    wanted = daily_impact.Params(forecast_of_country={"JP": 5005}, forecast_elsewhere=5006).wanted_forecast()
    return t["orders_forecast_adjusted"].filter(wanted).groupBy("country_code", "forecast_id").agg(F.count("*").alias("lines"))


@case("filter_date_part", """SELECT order_day, count(*) AS lines FROM orders_actuals
WHERE year(order_day) = 2000 AND dayofweek(order_day) = 6 GROUP BY ALL""")
def filter_date_part(t):
    day = F.col("order_day")
    return (t["orders_actuals"].filter(calendar.in_year(day, 2000) & (calendar.weekday(day) == 6)).groupBy("order_day")
            .agg(F.count("*").alias("lines")))


@case("filter_id_date_match", f"""SELECT portfolio_id, country_code, {dbl("sum(shipped_units)")} AS units FROM segment_forecast
WHERE strptime(forecast_date, '%Y%m%d') = strptime(portfolio_id[1:8], '%Y%m%d') AND strptime(portfolio_id[1:8], '%Y%m%d') >= DATE '2001-03-01'
GROUP BY ALL""")
def filter_id_date_match(t):
    id_day = calendar.id_date(F.col("portfolio_id"))
    rows = t["segment_forecast"].filter((F.try_to_date("forecast_date", "yyyyMMdd") == id_day) & calendar.on_or_after(id_day, "2001-03-01"))
    return rows.groupBy("portfolio_id", "country_code").agg(num(F.sum("shipped_units")).alias("units"))


@case("filter_month_window", """SELECT target_day, count(*) AS lines FROM shipment_actuals
WHERE target_day BETWEEN DATE '1999-06-01' AND DATE '2002-08-01' GROUP BY ALL""")
def filter_month_window(t):
    day = F.col("target_day")
    window = (day >= calendar.months_from(AS_OF, -25)) & (day <= calendar.months_from(AS_OF, 13))
    return t["shipment_actuals"].filter(window).groupBy("target_day").agg(F.count("*").alias("lines"))


@case("filter_forecast_horizon", """SELECT dataset_date, min(target_day) AS first_day, count(*) AS lines FROM shipment_forecasts
WHERE target_day >= dataset_date + 2 - CAST(isodow(dataset_date + 2) AS INTEGER) GROUP BY ALL""")
def filter_forecast_horizon(t):
    rows = t["shipment_forecasts"].filter(F.col("target_day") >= calendar.horizon_start(F.col("dataset_date")))
    return rows.groupBy("dataset_date").agg(F.min("target_day").alias("first_day"), F.count("*").alias("lines"))


@case("filter_up_to_latest_actual", """SELECT country_code, target_day, count(*) AS lines FROM orders_forecast_adjusted
JOIN (SELECT country_code, max(order_day) AS last_day FROM orders_actuals GROUP BY ALL) USING (country_code)
WHERE target_day <= last_day GROUP BY ALL""")
def filter_up_to_latest_actual(t):
    last = category_yoy.last_days(t.versions("orders_actuals"))
    daily = t["orders_forecast_adjusted"].groupBy("country_code", "target_day").agg(F.count("*").alias("lines"))
    return daily.join(last, "country_code").filter(F.col("target_day") <= F.col("max_order_day")).drop("max_order_day")


@case("filter_param_gate", f"""WITH {RECENT.format(modes="is_latest_publish = 'Y'")}, inside AS (
  SELECT DISTINCT portfolio_id FROM shipment_forecasts WHERE portfolio_status IN ('TEST', 'DRAFT'))
SELECT 'EXTERNAL' AS mode, portfolio_id, count(*) AS lines FROM shipment_forecasts SEMI JOIN ids USING (portfolio_id) GROUP BY ALL
UNION ALL
SELECT 'INTERNAL', portfolio_id, count(*) FROM shipment_forecasts
WHERE portfolio_id IN (SELECT portfolio_id FROM ids UNION SELECT portfolio_id FROM inside) GROUP BY ALL""")
def filter_param_gate(t):
    def lines(mode: str):
        ids = stage(member_comparison.portfolios(t, mode, "2001-01-01"), "portfolios")
        return (with_ids(t["shipment_forecasts"], ids, "portfolio_id", how="left_semi").groupBy(F.lit(mode).alias("mode"), "portfolio_id")
                .agg(F.count("*").alias("lines")))
    return lines("EXTERNAL").union(lines(member_comparison.INTERNAL))
