"""Pieces shared by several reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import labels, measures
from tallyloom.operators.joins import with_rate
from tallyloom.operators.selection import latest_versions

SEGMENT = ("country_code", "customer_group", "plan_status", "plan_type")


def kept_products(max_group: int) -> Column:
    """Product groups below a limit, without digital and unknown rollups."""
    return (F.col("gl_product_group") < max_group) & ~F.col("gl_rollup").isin(*labels.SKIPPED_ROLLUPS)


def order_revenue() -> Column:
    """Order revenue under the channel rule, in local currency."""
    return measures.channel_revenue(F.col("channel"), F.col("net_ops"), F.col("net_ordered_gms"))


def priced(groups: DataFrame, rates: DataFrame, *totals: str) -> DataFrame:
    """Groups with the totals converted; countries without a rate go.

    Sums are linear, so the rate meets the groups instead of every fact row.
    """
    return with_rate(groups, rates).withColumns({c: measures.converted_total(F.col(c)) for c in totals}).drop("fx_rate")


def canonical_names(gl_names: DataFrame) -> DataFrame:
    """One name per product group, 'Unknown' ignored."""
    return (gl_names.filter(F.col("gl_name") != "Unknown")
            .groupBy("gl_product_group").agg(F.max("gl_name").alias("gl_name")))


def numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Money and units leave the pipeline as DOUBLE."""
    return df.withColumns({c: measures.as_number(F.col(c)) for c in columns})


def latest_sets(sets: DataFrame) -> DataFrame:
    """Newest member set of each portfolio."""
    columns = ("portfolio_id", "set_id", "portfolio_set_created_time")
    return latest_versions(sets.select(*columns), ["portfolio_id"], "portfolio_set_created_time").select(
        "portfolio_id", "set_id")
