"""Revenue rules, currency, flows. Money stays DECIMAL until :func:`as_number`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RETAIL = "ret"


def channel_revenue(channel: Column, net: Column, gross: Column) -> Column:
    """Own retail counts net sales, every other channel counts gross sales."""
    return F.when(channel == RETAIL, net).otherwise(gross)


def market_revenue(country: Column, channel: Column, net: Column, gross: Column,
                   gross_only: tuple[str, ...] = ("IN",)) -> Column:
    """Like :func:`channel_revenue`, but some countries always count gross sales."""
    return F.when(country.isin(*gross_only), gross).otherwise(channel_revenue(channel, net, gross))


def converted(amount: Column, rate: Column | None = None) -> Column:
    """Amount in the target currency; NULL where the rate is missing."""
    return amount * (F.col("fx_rate") if rate is None else rate)


def converted_total(total: Column) -> Column:
    """A sum in the target currency.

    Sums of DECIMAL(18,s) are DECIMAL(28,s); times a DECIMAL(12,6) rate they would pass 38 digits and lose
    scale. 25 digits hold any total (19 before the point) and keep the product exact; a larger one raises,
    whether ANSI mode is on or off.
    """
    lost = F.raise_error(F.lit("a total has more than 19 digits before the point")).cast("decimal(25,6)")
    return F.coalesce(total.try_cast("decimal(25,6)"), F.when(total.isNotNull(), lost)) * F.col("fx_rate")


def net_flow(start: Column, convert_in: Column, cancel: Column, convert_out: Column) -> Column:
    return start + convert_in - cancel - convert_out


def per_day(total: Column, days: Column) -> Column:
    """Average daily balance, rounded to six places; NULL instead of an error for zero days."""
    return F.round(F.try_divide(total.cast("double"), days.cast("double")), 6)


def as_number(measure: Column) -> Column:
    return measure.cast("double")
