"""Classifications of codes and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import calendar

# Code lists of the reports.
NORTH_AMERICA = ("US", "CA")
EUROPE = ("UK", "DE", "FR", "IT", "ES")
YOY_COUNTRIES = ("CA", "UK", "DE", "FR", "IT", "ES", "US")
EIGHT_COUNTRIES = ("US", "CA", "UK", "DE", "FR", "IT", "ES", "JP")
NINE_COUNTRIES = EIGHT_COUNTRIES + ("IN",)
SKIPPED_ROLLUPS = ("dig", "unk")
PHYSICAL_ROLLUPS = ("hdl", "sft", "con", "med")
INTERVAL_ROLLUPS = ("all", "con", "sft", "hdl", "med")
MEDICAL_SUPPLY = (121, 194, 328)
OTHER_CONSUMABLES = (75, 325, 364, 370, 467, 510, 199)
WFH_ESSENTIALS = (229, 14, 63, 267, 201, 200, 196, 74, 60, 23, 15, 147, 21, 504, 261)
IN_MARKER = "[IN,INT,WW]"
EIGHT_MARKER = "[CA,DE,ES,EU,FR,INT,IT,JP,NA,UK,US,WW]"
KIDS_CLUSTERS, KIDS_BUCKET = ("Children", "WFH Essentials"), "WFH/Kids Essentials"
HOME_CLUSTERS, HOME_BUCKET = ("Household Care", "Hygiene/Medical Supplies"), "Hygiene/Medical/ Household Essentials"
GROCERY, SOFTLINES, OTHERS = "Grocery", "Softlines", "Others"
INTERVAL_CLASSES = ("IN CI", "8 countries CI", "other countries CI")
PRODUCT_BUCKETS = ("medical_supply", "other_consumables", "wfh_essentials", "others")


def region(country: Column) -> Column:
    """Region of a country; NULL for a country outside the map."""
    return (F.when(country.isin(*NORTH_AMERICA), "NA")
            .when(country.isin(*EUROPE), "EU")
            .when(country.isin("JP", "IN"), country))


def member_class(prime_group: Column) -> Column:
    """Members (students included) or not; an unknown group is not a member."""
    return F.when(prime_group.isin("prm", "stu"), "prm").otherwise("npr")


def product_bucket(product: Column) -> Column:
    code = F.coalesce(product.cast("int"), F.lit(0))
    medical, consumable, home, rest = PRODUCT_BUCKETS
    return (F.when(code.isin(*MEDICAL_SUPPLY), medical).when(code.isin(*OTHER_CONSUMABLES), consumable)
            .when(code.isin(*WFH_ESSENTIALS), home).otherwise(rest))


def cluster_bucket(cluster: Column, family: Column) -> Column:
    """First match wins: the semantic cluster, then the product family."""
    return (F.when(cluster.isin(*KIDS_CLUSTERS), KIDS_BUCKET).when(cluster.isin(*HOME_CLUSTERS), HOME_BUCKET)
            .when(cluster == GROCERY, GROCERY).when(family == SOFTLINES, SOFTLINES).otherwise(OTHERS))


def interval_class(description: Column) -> Column:
    """Class of an interval run; the brackets are literal text."""
    india, eight, rest = INTERVAL_CLASSES
    return (F.when(F.contains(description, F.lit(IN_MARKER)), india)
            .when(F.contains(description, F.lit(EIGHT_MARKER)), eight).otherwise(rest))


def tenure_band(tenures: Column, day: Column, cohort_month: Column) -> Column:
    """'0' for segments with a single tenure and for the first year of a cohort, else '1'."""
    young = calendar.whole_months_between(day, cohort_month) < 12
    return F.when((tenures == 1) | young, "0").otherwise("1")


def plan_status(customer_group: Column, status: Column) -> Column:
    """Non-members have no plan, so their group stands in for the status."""
    return F.when(customer_group == "npr", "npr").otherwise(status)


def product_label(code: Column, name: Column) -> Column:
    return F.concat(code.cast("string"), F.lit(" - "), name)


def published_id(portfolio: Column) -> Column:
    """Ids of published portfolios end in a or b; interim runs carry pit or bit."""
    return ((F.endswith(portfolio, F.lit("a")) | F.endswith(portfolio, F.lit("b")))
            & ~F.contains(portfolio, F.lit("pit")) & ~F.contains(portfolio, F.lit("bit")))
