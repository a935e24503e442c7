"""The derived sample tables once more, in SQL, as common table expressions for the oracle."""

from __future__ import annotations

import re

from tallyloom.sources.sample import LITERALS

_KEYS = "b.country_code, b.channel, b.gl_rollup, b.gl_product_group"

VIEWS: dict[str, str] = {
    **LITERALS,
    "base_sales": """SELECT l_orderkey AS order_key, l_linenumber AS line, c_custkey AS cust,
    CASE c_nationkey % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'UK' WHEN 3 THEN 'DE' WHEN 4 THEN 'FR'
      WHEN 5 THEN 'IT' WHEN 6 THEN 'ES' WHEN 7 THEN 'JP' WHEN 8 THEN 'IN' ELSE 'MX' END AS country_code,
    CASE WHEN l_linestatus = 'O' THEN 'ret' ELSE 'mkt' END AS channel,
    CASE p_type WHEN 'MEDIUM' THEN 'hdl' WHEN 'STANDARD' THEN 'sft' WHEN 'LARGE' THEN 'con'
      WHEN 'PROMO' THEN 'med' WHEN 'ECONOMY' THEN 'dig' ELSE 'unk' END AS gl_rollup,
    CASE p_partkey % 16 WHEN 0 THEN 14 WHEN 1 THEN 15 WHEN 2 THEN 21 WHEN 3 THEN 60 WHEN 4 THEN 75 WHEN 5 THEN 121
      WHEN 6 THEN 194 WHEN 7 THEN 199 WHEN 8 THEN 201 WHEN 9 THEN 328 WHEN 10 THEN 364 WHEN 11 THEN 467
      WHEN 12 THEN 510 WHEN 13 THEN 700 WHEN 14 THEN 990 ELSE 995 END AS gl_product_group,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS category_code,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'prm' WHEN 'MACHINERY' THEN 'stu' ELSE 'npr' END AS prime_group,
    CAST(o_orderdate AS DATE) AS order_day, CAST(l_shipdate AS DATE) AS ship_day,
    CAST(l_quantity AS DECIMAL(12,2)) AS units,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS gross
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""",
    "forecast_portfolios": "SELECT forecast_id, portfolio_id FROM portfolio_metadata",
    "forecast_metadata": """SELECT forecast_id, dataset_date, 'confidence_intervals' AS forecast_type, portfolio_status AS forecast_status,
    CASE forecast_id % 3 WHEN 0 THEN 'run [IN,INT,WW]' WHEN 1 THEN 'run [CA,DE,ES,EU,FR,INT,IT,JP,NA,UK,US,WW]'
      ELSE 'run [MX]' END AS forecast_description
  FROM portfolio_metadata""",
    "gl_names": """SELECT DISTINCT gl_product_group, CONCAT('Group ', CAST(gl_product_group AS VARCHAR)) AS gl_name
  FROM base_sales WHERE gl_product_group NOT IN (364, 510)
  UNION ALL VALUES (14, 'A group'), (364, 'Unknown'), (510, 'Unknown')""",
    "visible_products": """SELECT DISTINCT gl_product_group, CONCAT('Shown ', CAST(gl_product_group AS VARCHAR)) AS gl_name,
    CASE WHEN gl_product_group <> 700 THEN gl_product_group END AS visible_gl_product_group FROM base_sales""",
    "orders_actuals": """SELECT country_code, channel, gl_rollup, gl_product_group, category_code, prime_group, order_day,
    units AS net_ordered_units, net AS net_ops, gross AS net_ordered_gms FROM base_sales""",
    "shipment_actuals_all": """SELECT country_code, channel, channel AS subchannel, gl_rollup, gl_product_group,
    CASE WHEN gl_product_group IN (364, 510) THEN 'Unknown' WHEN gl_product_group = 14 AND channel = 'mkt' THEN 'A group'
      WHEN gl_product_group <> 467 THEN CONCAT('Group ', CAST(gl_product_group AS VARCHAR(10))) END AS gl_name, prime_group,
    dataset_date, ship_day AS target_day,
    CAST(date_trunc('week', CAST(ship_day + 1 AS TIMESTAMP)) AS DATE) - 1 AS target_week,
    CAST(date_trunc('month', CAST(ship_day AS TIMESTAMP)) AS DATE) AS target_month,
    units AS shipped_units, net AS product_revenue_amt, gross AS gross_gms_amt,
    CAST(net * 1.25 AS DECIMAL(18,6)) AS product_revenue_usd, CAST(gross * 1.25 AS DECIMAL(18,6)) AS gross_gms_usd
  FROM base_sales JOIN (VALUES (DATE '2001-07-01', DATE '9999-01-01'), (DATE '2001-05-01', DATE '2001-05-01')) AS d(dataset_date, ended)
    ON ship_day < ended""",
    "shipment_actuals": "FROM shipment_actuals_all WHERE dataset_date = DATE '2001-07-01'",
    "shipment_forecasts": f"""SELECT p.portfolio_id, p.portfolio_status, p.is_latest_publish, p.dataset_date, p.forecast_id,
    CASE WHEN b.line % 3 = 0 THEN 'promo_event' ELSE 'baseline' END AS initiative,
    CASE WHEN b.line % 3 = 0 THEN 'Event' ELSE 'Baseline' END AS initiative_type,
    b.country_code, b.channel, b.channel AS subchannel, b.gl_rollup, b.gl_product_group,
    CASE WHEN b.gl_product_group IN (364, 510) THEN 'Unknown' WHEN b.gl_product_group = 14 AND b.channel = 'mkt' THEN 'A group'
      WHEN b.gl_product_group <> 467 THEN CONCAT('Group ', CAST(b.gl_product_group AS VARCHAR(10))) END AS gl_name, b.prime_group, b.ship_day AS target_day,
    CAST(b.units * p.factor AS DECIMAL(18,4)) AS shipped_units, CAST(b.net * p.factor AS DECIMAL(18,6)) AS product_revenue_amt,
    CAST(b.gross * p.factor AS DECIMAL(18,6)) AS gross_gms_amt,
    CAST(CAST(b.net * p.factor AS DECIMAL(18,6)) * 1.25 AS DECIMAL(18,6)) AS product_revenue_usd,
    CAST(CAST(b.gross * p.factor AS DECIMAL(18,6)) * 1.25 AS DECIMAL(18,6)) AS gross_gms_usd
  FROM base_sales b JOIN portfolio_metadata p ON b.ship_day >= p.dataset_date - 400 AND (b.order_key + p.forecast_id) % 4 <> 0""",
    "orders_forecast_daily": f"""SELECT p.forecast_id + k.off AS forecast_id, k.forecast_type, p.dataset_date, {_KEYS},
    b.prime_group, b.order_day AS target_day, CAST(b.units * p.factor AS DECIMAL(18,4)) AS net_ordered_units,
    CAST(b.net * p.factor AS DECIMAL(18,6)) AS net_ops, CAST(b.gross * p.factor AS DECIMAL(18,6)) AS net_ordered_gms
  FROM base_sales b JOIN portfolio_metadata p ON b.order_day >= p.dataset_date - 400 AND (b.order_key + p.forecast_id) % 5 <> 0,
    (VALUES ('Adjusted', 0), ('Baseline', 1000)) AS k(forecast_type, off)""",
    "orders_forecast_adjusted": "SELECT * FROM orders_forecast_daily WHERE forecast_type = 'Adjusted'",
    "confidence_intervals": """SELECT forecast_id, forecast_date, '2001-06-03' AS range_start, '2001-06-09' AS range_end, 'week' AS grain,
    country_code, channel, gl_rollup AS gl_rollup_code, CAST(q.quantile AS DECIMAL(2,1)) AS quantile, units AS shipped_units,
    CAST(units * q.quantile AS DECIMAL(18,4)) AS shipped_units_percentile_value,
    gms AS gms_prv, CAST(gms * q.quantile AS DECIMAL(20,4)) AS gms_prv_percentile_value
  FROM (SELECT forecast_id, dataset_date AS forecast_date, country_code, channel, gl_rollup,
      CAST(sum(shipped_units) AS DECIMAL(18,4)) AS units, CAST(sum(gross_gms_amt) AS DECIMAL(20,4)) AS gms
    FROM shipment_forecasts GROUP BY ALL) s, (VALUES (0.1), (0.5), (0.9)) AS q(quantile)""",
    "speed_facts": """SELECT CASE country_code WHEN 'US' THEN 0 WHEN 'CA' THEN 1 WHEN 'UK' THEN 2 WHEN 'DE' THEN 3 WHEN 'FR' THEN 4
      WHEN 'IT' THEN 5 WHEN 'ES' THEN 6 WHEN 'JP' THEN 7 WHEN 'IN' THEN 8 ELSE 9 END AS marketplace_id,
    channel AS fn_channel, gl_product_group, category_code, category_code AS category_desc, gl_rollup AS wbr_gl_description,
    CASE WHEN gl_rollup = 'sft' THEN 'Softlines' ELSE 'Hardlines' END AS wbr_gl_family,
    CASE WHEN line % 2 = 0 THEN 'Y' ELSE 'N' END AS in_country, 'Y' AS in_region,
    CASE WHEN line = 7 THEN NULL ELSE CAST((order_key + gl_product_group) % 45 AS INTEGER) END AS gvs_prod_int,
    CAST(units AS BIGINT) AS gv_count, order_day AS snapshot_day FROM base_sales""",
    "segment_forecast": """SELECT portfolio_id, substring(portfolio_id, 1, 8) AS forecast_date, 'Refresh' AS cs_tag, initiative,
    country_code, prime_group AS customer_group,
    CASE WHEN prime_group = 'npr' THEN 'npr' WHEN channel = 'ret' THEN 'paid' ELSE 'free' END AS plan_status,
    CASE WHEN gl_product_group % 2 = 0 THEN 'annual' ELSE 'monthly' END AS plan_type,
    CASE WHEN gl_product_group % 3 = 0 THEN '1' ELSE '0' END AS tenure,
    channel, subchannel, gl_rollup, gl_product_group, target_day, shipped_units, product_revenue_amt, gross_gms_amt
  FROM shipment_forecasts""",
    "member_actuals": """SELECT country_code, prime_group AS customer_group, CASE WHEN channel = 'ret' THEN 'paid' ELSE 'free' END AS plan_status,
    CASE WHEN cust % 2 = 0 THEN 'annual' ELSE 'monthly' END AS plan_type, order_day AS snapshot_day, order_day AS target_day,
    CAST(count(*) * 100 AS BIGINT) AS member_count, CAST(sum(line) AS BIGINT) AS start_count, CAST(count(*) AS BIGINT) AS cancel_count,
    CAST(sum(line % 2) AS BIGINT) AS convert_in_count, CAST(sum(line % 3) AS BIGINT) AS convert_out_count
  FROM base_sales GROUP BY 1, 2, 3, 4, 5""",
    "member_runs": """SELECT s.run_id, a.country_code, a.customer_group, a.plan_status, a.plan_type, a.target_day,
    a.member_count + 10 AS member_count, a.start_count, a.cancel_count, a.convert_in_count, a.convert_out_count
  FROM member_actuals a, member_sets s WHERE a.target_day >= DATE '2000-01-01'""",
    "member_cohort_runs": """SELECT r.run_id, r.country_code, r.customer_group, r.plan_status, r.plan_type, c.cohort_month, r.target_day,
    r.member_count FROM member_runs r, (VALUES (DATE '1999-06-01'), (DATE '2000-01-01')) AS c(cohort_month)""",
    "member_rates": """SELECT run_id, country_code, customer_group, plan_status, plan_type, target_day,
    CAST(cancel_count AS DOUBLE) / CAST(member_count AS DOUBLE) AS cancel_rate,
    CAST(convert_in_count AS DOUBLE) / CAST(member_count AS DOUBLE) AS convert_in_rate,
    CAST(convert_out_count AS DOUBLE) / CAST(member_count AS DOUBLE) AS convert_out_rate,
    CAST(start_count AS DOUBLE) / CAST(member_count AS DOUBLE) AS start_rate FROM member_runs""",
    "member_shock": """SELECT country_code, customer_group, plan_status, plan_type, target_day, CAST(member_count / 100 AS BIGINT) AS member_count
  FROM member_actuals WHERE country_code = 'US' AND target_day >= DATE '2000-01-01'""",
}


def _mentioned(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql.lower()))
    return [n for n in VIEWS if n in words]


def _visit(sql: str, own: str, done: dict[str, None]) -> None:
    for name in _mentioned(sql):
        if name != own and name not in done:
            _visit(VIEWS[name], name, done)
            done[name] = None


def with_views(sql: str) -> str:
    """``sql`` with the views it needs in front. Extra CTEs of the text itself start with ``WITH``."""
    needed: dict[str, None] = {}
    _visit(sql, "", needed)
    head = ",\n".join(f"{n} AS (\n  {VIEWS[n]})" for n in needed)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
