"""Columns of the logical tables, as DDL. Money and units are decimals, days are dates."""

from __future__ import annotations

_SALES_KEYS = "country_code string, channel string, gl_rollup string, gl_product_group int"
_SHIP_KEYS = ("country_code string, channel string, subchannel string, gl_rollup string, gl_product_group int, gl_name string, "
              "prime_group string")
_SHIP_ACTUALS = (f"{_SHIP_KEYS}, dataset_date date, target_day date, target_week date, target_month date, shipped_units decimal(12,2), "
                 "product_revenue_amt decimal(18,4), gross_gms_amt decimal(18,4), product_revenue_usd decimal(18,6), "
                 "gross_gms_usd decimal(18,6)")
_SEGMENT = "country_code string, customer_group string, plan_status string, plan_type string"
_FLOWS = "member_count bigint, start_count bigint, cancel_count bigint, convert_in_count bigint, convert_out_count bigint"
_FORECAST_MONEY = "decimal(18,6)"
_ORDER_FORECAST = (
    f"forecast_id int, forecast_type string, dataset_date date, {_SALES_KEYS}, prime_group string, target_day date, "
    f"net_ordered_units decimal(18,4), net_ops {_FORECAST_MONEY}, net_ordered_gms {_FORECAST_MONEY}")

SCHEMAS: dict[str, str] = {
    # lists and dimensions
    "portfolio_metadata": "portfolio_id string, dataset_date date, portfolio_status string, is_latest_publish string, "
                          "forecast_id int, factor decimal(4,2), creation_date date, created_by string, published string",
    "portfolio_pins": "portfolio_id string",
    "forecast_portfolios": "forecast_id int, portfolio_id string",
    "forecast_metadata": "forecast_id int, dataset_date date, forecast_type string, forecast_status string, "
                         "forecast_description string",
    "fx_rates": "source_country_code string, target_country_code string, scenario string, fx_rate decimal(12,6), "
                "updated_date date",
    "fx_scenario": "scenario string",
    "dataset_reference": "dataset_date date, data_type_name string, fx_scenario string",
    "gl_names": "gl_product_group int, gl_name string",  # master list, several names per product
    "visible_products": "gl_product_group int, gl_name string, visible_gl_product_group int",
    "promise_extension": "country_code string, gl_product_group int, category_code string, promise_extension string",
    "boss_categories": "country_code string, gl_product_group int, category_code string, boss string",
    "category_mapping": "category_desc string, semantic_cluster string",
    "marketplaces": "id int, region string, country string",
    "speed_buckets": "range_min int, range_max int, gvs string",
    "member_portfolio_sets": "set_id string, portfolio_id string, portfolio_set_created_time date",
    "member_snapshot_day_sets": "set_id string, snapshot_day date, snapshot_day_set_created_time date",
    "member_sets": "set_id string, forecast_date date, scenario string, run_id string",
    # facts
    "orders_actuals": f"{_SALES_KEYS}, category_code string, prime_group string, order_day date, "
                      "net_ordered_units decimal(12,2), net_ops decimal(18,4), net_ordered_gms decimal(18,4)",
    "orders_forecast_daily": _ORDER_FORECAST,
    "orders_forecast_adjusted": _ORDER_FORECAST,
    "shipment_actuals": _SHIP_ACTUALS,  # rows of the newest dataset
    "shipment_actuals_all": _SHIP_ACTUALS,  # rows of every dataset
    "shipment_forecasts": "portfolio_id string, portfolio_status string, is_latest_publish string, dataset_date date, "
                          f"forecast_id int, initiative string, initiative_type string, {_SHIP_KEYS}, target_day date, "
                          f"shipped_units decimal(18,4), product_revenue_amt {_FORECAST_MONEY}, gross_gms_amt {_FORECAST_MONEY}, "
                          f"product_revenue_usd {_FORECAST_MONEY}, gross_gms_usd {_FORECAST_MONEY}",
    "confidence_intervals": "forecast_id int, forecast_date date, range_start string, range_end string, grain string, "
                            "country_code string, channel string, gl_rollup_code string, quantile decimal(2,1), "
                            "shipped_units decimal(18,4), shipped_units_percentile_value decimal(18,4), "
                            "gms_prv decimal(20,4), gms_prv_percentile_value decimal(20,4)",
    "speed_facts": "marketplace_id int, fn_channel string, gl_product_group int, category_code string, category_desc string, "
                   "wbr_gl_description string, wbr_gl_family string, in_country string, in_region string, gvs_prod_int int, "
                   "gv_count bigint, snapshot_day date",
    "segment_forecast": f"portfolio_id string, forecast_date string, cs_tag string, initiative string, {_SEGMENT}, tenure string, "
                        "channel string, subchannel string, gl_rollup string, gl_product_group int, target_day date, "
                        f"shipped_units decimal(18,4), product_revenue_amt {_FORECAST_MONEY}, gross_gms_amt {_FORECAST_MONEY}",
    "member_actuals": f"{_SEGMENT}, snapshot_day date, target_day date, {_FLOWS}",
    "member_runs": f"run_id string, {_SEGMENT}, target_day date, {_FLOWS}",
    "member_cohort_runs": f"run_id string, {_SEGMENT}, cohort_month date, target_day date, member_count bigint",
    "member_rates": f"run_id string, {_SEGMENT}, target_day date, cancel_rate double, convert_in_rate double, "
                    "convert_out_rate double, start_rate double",
    "member_shock": f"{_SEGMENT}, target_day date, member_count bigint",
}

# Columns whose distinct rows are a short list, stored beside the fact: what names its versions, or the days on which it has rows.
VERSION_OF: dict[str, tuple[str, ...]] = {
    "shipment_forecasts": ("portfolio_id", "portfolio_status", "is_latest_publish", "dataset_date"),
    "orders_forecast_daily": ("forecast_type", "dataset_date", "forecast_id"),
    "orders_forecast_adjusted": ("forecast_type", "dataset_date", "forecast_id"),
    "shipment_actuals_all": ("dataset_date",),
    "shipment_actuals": ("country_code", "target_day"),
    "orders_actuals": ("country_code", "order_day"),
    "member_actuals": ("country_code", "target_day"),
}

# Ids by which reports choose rows of a fact: a stored month is sorted by them, so that an id lies in few row groups.
CLUSTERED_BY: dict[str, tuple[str, ...]] = {
    "shipment_forecasts": ("portfolio_id",),
    "orders_forecast_daily": ("forecast_id",),
    "orders_forecast_adjusted": ("forecast_id",),
    "confidence_intervals": ("forecast_id",),
    "segment_forecast": ("portfolio_id",),
    "member_runs": ("run_id",),
    "member_cohort_runs": ("run_id",),
    "member_rates": ("run_id",),
}

# Day column by which a stored fact is split into month folders.
DAY_OF: dict[str, str] = {
    "orders_actuals": "order_day",
    "orders_forecast_daily": "target_day",
    "orders_forecast_adjusted": "target_day",
    "shipment_actuals": "target_day",
    "shipment_actuals_all": "target_day",
    "shipment_forecasts": "target_day",
    "speed_facts": "snapshot_day",
    "segment_forecast": "target_day",
    "member_actuals": "target_day",
    "member_runs": "target_day",
    "member_cohort_runs": "target_day",
    "member_rates": "target_day",
    "member_shock": "target_day",
}
