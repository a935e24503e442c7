"""Confidence intervals of the newest published portfolios, reviewed by run class."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import labels
from tallyloom.operators.selection import newest, newest_rows, ranked
from tallyloom.plans.common import numbers
from tallyloom.sources.tables import Tables


@dataclass(frozen=True)
class Params:
    portfolios: int = 3
    creators: tuple[str, ...] = ("root",)
    forecast_type: str = "confidence_intervals"
    rollups: tuple[str, ...] = labels.INTERVAL_ROLLUPS
    country: str = "IN"


MEASURES = ("quantile", "shipped_units", "shipped_units_percentile_value", "gms_prv", "gms_prv_percentile_value")
COLUMNS = ("rank", "portfolio_id", "ci_type", "forecast_id", "forecast_date", "range_start", "range_end", "grain",
           "country_code", "channel", "gl_rollup_code", *MEASURES)


def latest_portfolios(t: Tables, p: Params) -> DataFrame:
    published = t["portfolio_metadata"].filter(
        (F.col("portfolio_status") == "PRODUCTION") & F.col("created_by").isin(*p.creators)
        & (F.col("published") == "true"))
    # newest first, cut to n rows, then ranked: the rank of a row does not depend on older rows
    kept = newest_rows(published.select("portfolio_id", "dataset_date", "creation_date", "portfolio_status"),
                       p.portfolios, "creation_date", "portfolio_id")
    return ranked(kept, newest("creation_date"), ["portfolio_status"]).select("portfolio_id", "dataset_date", "rank")


def interval_runs(t: Tables, p: Params) -> DataFrame:
    runs = (t["forecast_metadata"].filter(F.col("forecast_type") == p.forecast_type)
            .join(t["forecast_portfolios"], "forecast_id")
            .join(latest_portfolios(t, p), ["portfolio_id", "dataset_date"]))
    status, rank = F.col("forecast_status"), F.col("rank")
    newest_or_final = (status.isin("PRODUCTION", "DRAFT") & (rank == 1)) | ((status == "PRODUCTION") & (rank > 1))
    return runs.filter(newest_or_final).select(
        "rank", "portfolio_id", "forecast_id", F.col("dataset_date").alias("forecast_date"),
        labels.interval_class(F.col("forecast_description")).alias("ci_type"))


def report(t: Tables, p: Params = Params()) -> DataFrame:
    short = {c: F.left(F.col(c), F.lit(3)) for c in ("country_code", "channel", "gl_rollup_code")}
    bounds = {c: F.to_date(F.col(c), "yyyy-MM-dd") for c in ("range_start", "range_end")}
    kind = F.col("ci_type")
    india, eight, _ = labels.INTERVAL_CLASSES
    rows = (t["confidence_intervals"].filter(F.col("gl_rollup_code").isin(*p.rollups))
            .join(interval_runs(t, p), ["forecast_id", "forecast_date"])
            .filter((kind == eight) | ((kind == india) & (F.col("country_code") == p.country))))
    shown = numbers(rows.withColumns({**short, **bounds}).select(*COLUMNS), *MEASURES)
    # the remaining columns make the order total, so equal leading keys can be split between tasks
    return shown.orderBy(*COLUMNS)
