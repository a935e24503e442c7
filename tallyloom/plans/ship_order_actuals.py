"""Long table of orders and shipments: actuals, final forecasts, system forecasts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, measures
from tallyloom.operators.grains import final_and_system
from tallyloom.operators.joins import rates_of
from tallyloom.operators.selection import largest, latest_id_per, with_ids
from tallyloom.operators.staging import stage
from tallyloom.plans.common import kept_products, numbers, order_revenue, priced
from tallyloom.sources.tables import Tables

FORECAST_REFRESH = 10_000  # days before the dataset date: marks a row as a forecast
LABEL = 40  # length of a data type
FINAL, SYSTEM = "Final", "System"
MEASURES = ("units", "prv_gms_usd", "gms_usd", "prv_usd")
COLUMNS = ("refresh_date", "dataset_date", "source", "data_stream", "data_type", "country_code", "channel", "subchannel",
           "gl_rollup", "gl_product_group", "gl_name", "prime_group", "target_day", "day_of_week", "target_week",
           "week_number", "year_of_week", "target_month", "month_number", "year_number", *MEASURES)


@dataclass(frozen=True)
class Params:
    target_country: str = "US"
    countries: tuple[str, ...] = labels.EIGHT_COUNTRIES
    after_year: int = 2013
    before_year: int = 2021
    max_group: int = 990


def _order_sums() -> dict[str, Column]:
    """Orders are converted after the sum."""
    return {"units": F.col("net_ordered_units"), "prv_gms_usd": order_revenue(), "gms_usd": F.col("net_ordered_gms"), "prv_usd": F.col("net_ops")}


def _shipment_sums() -> dict[str, Column]:
    """Shipments carry their amounts in the target currency."""
    net, gross = F.col("product_revenue_usd"), F.col("gross_gms_usd")
    return {"units": F.col("shipped_units"), "prv_gms_usd": measures.channel_revenue(F.col("channel"), net, gross),
            "gms_usd": gross, "prv_usd": net}


def _summed(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def _tagged(df: DataFrame, stream: str, data_type: Column, refresh: Column, subchannel: Column) -> DataFrame:
    """Bring a branch to the common columns; all calendar columns follow from the day."""
    day, blank = F.col("target_day"), F.lit("")
    week = calendar.week_start(day)
    if "dataset_date" not in df.columns:
        df = df.withColumn("dataset_date", F.lit(None).cast("date"))
    return df.withColumns({
        "refresh_date": refresh, "source": F.lit(1), "data_stream": F.lit(stream),
        "data_type": F.left(data_type, F.lit(LABEL)), "subchannel": subchannel, "gl_rollup": blank,
        "gl_product_group": blank, "gl_name": blank, "day_of_week": calendar.weekday(day) + 1, "target_week": week,
        "week_number": calendar.planning_week_text(day), "year_of_week": calendar.week_label_year(week),
        "target_month": F.trunc(day, "month"), "month_number": F.month(day), "year_number": F.year(day)}).select(*COLUMNS)


def _labels(names: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``(dataset_date, kind, data_type)``: the names of a dataset date as they are cut, each once."""
    kind = F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind")
    label = F.left(F.concat(F.col("data_type_name"), F.lit(" "), F.col("kind"), F.lit(" Forecast")), F.lit(LABEL))
    return names.select("dataset_date", "data_type_name", kind).select("dataset_date", "kind", label.alias("data_type")).distinct()


def report(t: Tables, p: Params = Params()) -> DataFrame:
    reference = t["dataset_reference"]
    scenario = largest(reference, "fx_scenario")
    rates = rates_of(t["fx_rates"], scenario, p.target_country, p.countries)
    names = reference.select("dataset_date", "data_type_name").distinct()
    dates = names.select("dataset_date").distinct()
    kept = kept_products(p.max_group)
    day = F.col("target_day")
    past = (calendar.year_start(p.after_year + 1), None)
    future = (None, calendar.year_end(p.before_year - 1))
    ahead = day >= calendar.horizon_start(F.col("dataset_date"))
    blank, sub = F.lit(""), F.col("subchannel")

    def chosen(versions: DataFrame, identifier: str) -> DataFrame:
        ids = latest_id_per(versions.join(dates, "dataset_date", "left_semi"), "dataset_date", identifier)
        return stage(ids, "dataset-ids")

    # names and labels meet the sums: a dataset with several names repeats its groups, not its rows
    named = stage(_labels(names, (FINAL, SYSTEM)), "labels")
    forecast_refresh = F.date_sub("dataset_date", FORECAST_REFRESH)
    order_keys = ["country_code", "channel", "prime_group", "target_day"]
    ship_keys = ["country_code", "channel", "subchannel", "prime_group", "target_day"]

    ordered = t.days("orders_actuals", past).filter(kept)
    orders = _tagged(priced(_summed(ordered.withColumnRenamed("order_day", "target_day"), order_keys, _order_sums()), rates, *MEASURES[1:]),
                     "Orders", F.lit("Actuals"), day, blank)

    newest = largest(t.versions("shipment_actuals_all"), "dataset_date")
    shipped = t.days("shipment_actuals_all", past).filter(kept & (F.col("dataset_date") == newest))
    shipments = _tagged(_summed(shipped, ship_keys, _shipment_sums()),
                        "Shipments", F.lit("Actuals"), day, sub)

    published = F.col("portfolio_status") == "PRODUCTION"
    ids = chosen(t.versions("shipment_forecasts").filter(published), "portfolio_id")
    planned = with_ids(t.days("shipment_forecasts", future).filter(published & kept & ahead), ids, "portfolio_id", "dataset_date")
    both = final_and_system(planned, ["dataset_date", *ship_keys], _shipment_sums(), F.col("initiative_type") == "Baseline", (FINAL, SYSTEM), tag="kind")
    ship_forecasts = _tagged(both.join(named, ["dataset_date", "kind"]), "Shipments", F.col("data_type"), forecast_refresh, sub)

    def order_forecasts(fact: str, kind: str, name: str) -> DataFrame:
        rows = with_ids(t.days(fact, future).filter(kept & ahead & (F.col("forecast_type") == kind)), chosen(t.versions(fact), "forecast_id"),
                        "forecast_id", "dataset_date")
        sums = priced(_summed(rows, ["dataset_date", *order_keys], _order_sums()), rates, *MEASURES[1:])
        return _tagged(sums.join(named.filter(F.col("kind") == name), "dataset_date"), "Orders", F.col("data_type"), forecast_refresh, blank)

    final_orders = order_forecasts("orders_forecast_adjusted", "Adjusted", FINAL)
    system_orders = order_forecasts("orders_forecast_daily", "Baseline", SYSTEM)
    # Groups are unique per stream, kind and label, so a set union finds equal rows only where the cut takes the kind away and a final label meets a
    # system one. The list of labels tells.
    forecasts = ship_forecasts.union(final_orders).union(system_orders)
    if not named.groupBy("dataset_date", "data_type").count().where("count > 1").isEmpty():
        forecasts = forecasts.distinct()
    everything = orders.union(shipments).union(forecasts)
    return numbers(everything, *MEASURES)
