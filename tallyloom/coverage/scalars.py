"""Scalar functions, each over a whole fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.coverage.registry import case, dbl
from tallyloom.coverage.tables_and_columns import num
from tallyloom.functions import calendar, labels
from tallyloom.plans import category_yoy


def counted(df, *keys):
    return df.groupBy(*keys).agg(F.count("*").alias("lines"))


@case("fn_coalesce_nvl", "SELECT ifnull(category_code, 'none') AS category, order_day, count(*) AS lines FROM orders_actuals GROUP BY ALL")
def fn_coalesce_nvl(t):
    return counted(t["orders_actuals"], F.coalesce("category_code", F.lit("none")).alias("category"), "order_day")


@case("fn_least", "SELECT marketplace_id, if(gvs_prod_int IS NULL OR gvs_prod_int > 35, 35, gvs_prod_int) AS speed, count(*) AS lines FROM speed_facts GROUP BY ALL")
def fn_least(t):
    return counted(t["speed_facts"], "marketplace_id", F.least("gvs_prod_int", F.lit(35)).alias("speed"))


@case("fn_left_right", """SELECT left(portfolio_id, 4) AS head, right(portfolio_id, 3) AS tail, count(*) AS lines FROM shipment_forecasts GROUP BY ALL""")
def fn_left_right(t):
    pid = F.col("portfolio_id")
    return counted(t["shipment_forecasts"], F.left(pid, F.lit(4)).alias("head"), F.right(pid, F.lit(3)).alias("tail"))


@case("fn_substring", "SELECT portfolio_id[1:8] AS id_day, target_day, count(*) AS lines FROM shipment_forecasts GROUP BY ALL")
def fn_substring(t):
    return counted(t["shipment_forecasts"], F.substring("portfolio_id", 1, 8).alias("id_day"), "target_day")


@case("fn_split_part", """SELECT split_part(CAST(snapshot_day AS VARCHAR), '-', 1) AS y, split_part(CAST(snapshot_day AS VARCHAR), '-', 2) AS m,
  split_part(CAST(snapshot_day AS VARCHAR), '-', 3) AS d, count(*) AS lines FROM member_actuals GROUP BY ALL""")
def fn_split_part(t):
    text = F.col("snapshot_day").cast("string")
    return counted(t["member_actuals"], *[F.split_part(text, F.lit("-"), F.lit(i)).alias(n) for i, n in ((1, "y"), (2, "m"), (3, "d"))])


@case("fn_concat", """SELECT if(category_code IS NULL, NULL, format('{} - {}', gl_product_group, category_code)) AS label, count(*) AS lines FROM orders_actuals GROUP BY ALL""")
def fn_concat(t):
    return counted(t["orders_actuals"], labels.product_label(F.col("gl_product_group"), F.col("category_code")).alias("label"))


@case("fn_plus_concat", "SELECT forecast_type || ' Forecast' AS data_type, dataset_date, count(*) AS lines FROM orders_forecast_daily GROUP BY ALL")
def fn_plus_concat(t):
    return counted(t["orders_forecast_daily"], F.concat("forecast_type", F.lit(" Forecast")).alias("data_type"), "dataset_date")


@case("fn_to_date", "SELECT make_date(CAST(forecast_date[1:4] AS INT), CAST(forecast_date[5:6] AS INT), CAST(forecast_date[7:8] AS INT)) AS run_day, count(*) AS lines FROM segment_forecast GROUP BY ALL")
def fn_to_date(t):
    return counted(t["segment_forecast"], F.to_date("forecast_date", "yyyyMMdd").alias("run_day"))


@case("fn_date_cast", "SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS lines FROM lineitem GROUP BY ALL")
def fn_date_cast(t):
    return counted(t["lineitem"], F.col("l_shipdate").cast("date").alias("ship_day"))


@case("fn_cast", """SELECT CAST(gl_product_group AS VARCHAR) AS product, CAST(trunc(units) AS INTEGER) AS whole_units, initiative[:5] AS short_initiative, count(*) AS lines
FROM (SELECT *, CAST(shipped_units AS DOUBLE) AS units FROM shipment_forecasts) GROUP BY ALL""")
def fn_cast(t):
    return counted(t["shipment_forecasts"], F.col("gl_product_group").cast("string").alias("product"),
                   F.col("shipped_units").cast("double").cast("int").alias("whole_units"),
                   F.left(F.col("initiative"), F.lit(5)).alias("short_initiative"))


@case("fn_extract_parts", """SELECT CAST(date_part('year', order_day) AS INTEGER) AS y, CAST(date_part('quarter', order_day) AS INTEGER) AS q,
  CAST(date_part('month', order_day) AS INTEGER) AS m, CAST(date_part('day', order_day) AS INTEGER) AS d, count(*) AS lines FROM orders_actuals GROUP BY ALL""")
def fn_extract_parts(t):
    day = F.col("order_day")
    return counted(t["orders_actuals"], F.year(day).alias("y"), F.quarter(day).alias("q"), F.month(day).alias("m"), F.dayofmonth(day).alias("d"))


@case("fn_dow", "SELECT order_day, CAST(isodow(order_day) % 7 AS INTEGER) AS dow, count(*) AS lines FROM orders_actuals GROUP BY ALL")
def fn_dow(t):
    return counted(t["orders_actuals"], "order_day", calendar.weekday(F.col("order_day")).alias("dow"))


@case("fn_iso_year_week", """SELECT order_day, CAST(strftime(order_day + 1, '%G') AS INTEGER) AS year, strftime(order_day + 1, '%V') AS week, count(*) AS lines
FROM orders_actuals GROUP BY ALL""")
def fn_iso_year_week(t):
    day = F.col("order_day")
    return counted(t["orders_actuals"], "order_day", calendar.planning_year(day).alias("year"), calendar.planning_week_text(day).alias("week"))


@case("fn_sunday_week_start", """SELECT order_day, CAST(date_trunc('week', order_day + 1) AS DATE) - 1 AS week_start, count(*) AS lines FROM orders_actuals GROUP BY ALL""")
def fn_sunday_week_start(t):
    return counted(t["orders_actuals"], "order_day", calendar.week_start(F.col("order_day")).alias("week_start"))


@case("fn_week_year_label", """SELECT target_week, CAST(year(target_week + 6) AS INTEGER) AS year_of_week, count(*) AS lines FROM shipment_actuals GROUP BY ALL""")
def fn_week_year_label(t):
    return counted(t["shipment_actuals"], "target_week", calendar.week_label_year(F.col("target_week")).alias("year_of_week"))


@case("fn_date_trunc", """SELECT order_day, make_date(year(order_day), month(order_day), 1) AS month_start, make_date(year(order_day), quarter(order_day) * 3 - 2, 1) AS quarter_start,
  make_date(year(order_day), 1, 1) AS year_start, count(*) AS lines FROM orders_actuals GROUP BY ALL""")
def fn_date_trunc(t):
    day = F.col("order_day")
    starts = [calendar.period_start(day, g).alias(n) for g, n in (("Monthly", "month_start"), ("Quarterly", "quarter_start"), ("Yearly", "year_start"))]
    return counted(t["orders_actuals"], "order_day", *starts)


@case("fn_date_shift", "SELECT order_day, order_day + 1 AS next_day, order_day - 10000 AS marked_day, count(*) AS lines FROM orders_actuals GROUP BY ALL")
def fn_date_shift(t):
    day = F.col("order_day")
    return counted(t["orders_actuals"], "order_day", F.date_add(day, 1).alias("next_day"), F.date_sub(day, 10000).alias("marked_day"))


@case("fn_add_months", "SELECT order_day, CAST(order_day - INTERVAL 25 MONTH AS DATE) AS back, CAST(order_day + INTERVAL 13 MONTH AS DATE) AS ahead, count(*) AS lines FROM orders_actuals GROUP BY ALL")
def fn_add_months(t):
    day = F.col("order_day")
    return counted(t["orders_actuals"], "order_day", F.add_months(day, -25).alias("back"), F.add_months(day, 13).alias("ahead"))


@case("fn_months_between", """SELECT order_day, ship_day, CAST(m - CAST(day(ship_day) < day(order_day)
    AND NOT (ship_day = last_day(ship_day) AND order_day = last_day(order_day)) AS INTEGER) AS INTEGER) AS months, count(*) AS lines
FROM (SELECT *, (year(ship_day) - year(order_day)) * 12 + month(ship_day) - month(order_day) AS m FROM base_sales) GROUP BY ALL""")
def fn_months_between(t):
    months = calendar.whole_months_between(F.col("ship_day"), F.col("order_day"))
    return counted(t["base_sales"], "order_day", "ship_day", months.alias("months"))


@case("fn_last_day", "SELECT order_day, CAST(day(last_day(order_day)) AS INTEGER) AS days_in_month, count(*) AS lines FROM orders_actuals GROUP BY ALL")
def fn_last_day(t):
    return counted(t["orders_actuals"], "order_day", calendar.days_in_month(F.col("order_day")).alias("days_in_month"))


@case("fn_date_diff", """SELECT country_code, CAST(last_day - order_day AS INTEGER) AS age, count(*) AS lines FROM orders_actuals
JOIN (SELECT country_code, max(order_day) AS last_day FROM orders_actuals GROUP BY ALL) USING (country_code) GROUP BY ALL""")
def fn_date_diff(t):
    daily = counted(t["orders_actuals"], "country_code", "order_day")
    age = F.datediff(F.col("max_order_day"), F.col("order_day"))
    return daily.join(category_yoy.last_days(t["orders_actuals"]), "country_code").select("country_code", age.alias("age"), "lines")


@case("fn_format_date", "SELECT strftime(dataset_date, '%Y-%m-%d') AS portfolio_id, forecast_type, count(*) AS lines FROM orders_forecast_daily GROUP BY ALL")
def fn_format_date(t):
    return counted(t["orders_forecast_daily"], F.date_format("dataset_date", "yyyy-MM-dd").alias("portfolio_id"), "forecast_type")


@case("fn_current_date", """SELECT CAST(year(order_day) AS INTEGER) AS y, count(*) AS lines FROM orders_actuals
WHERE order_day <= date_trunc('month', current_date) + INTERVAL 13 MONTH GROUP BY ALL""")
def fn_current_date(t):
    return counted(t["orders_actuals"].filter(F.col("order_day") <= calendar.months_from(None, 13)), F.year("order_day").alias("y"))


@case("fn_arithmetic", f"""SELECT country_code, channel, {dbl("sum(gross_gms_amt - product_revenue_amt)")} AS discount,
  round(CAST({dbl("sum(gross_gms_amt)")} / {dbl("sum(shipped_units)")} AS DOUBLE), 6) AS price FROM shipment_actuals GROUP BY ALL""")
def fn_arithmetic(t):
    price = F.try_divide(num(F.sum("gross_gms_amt")), num(F.sum("shipped_units")))
    return t["shipment_actuals"].groupBy("country_code", "channel").agg(
        num(F.sum(F.col("gross_gms_amt") - F.col("product_revenue_amt"))).alias("discount"), F.round(price, 6).alias("price"))
