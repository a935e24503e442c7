"""Product views by delivery-speed bucket, custom group and promise extension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import labels
from tallyloom.operators.joins import range_join, specific_or_default
from tallyloom.sources.tables import Tables

FACT_KEYS = ("marketplace_id", "fn_channel", "gl_product_group", "category_code", "category_desc", "wbr_gl_description", "wbr_gl_family",
             "in_country", "in_region", "gvs_prod_int", "snapshot_day")


@dataclass(frozen=True)
class Params:
    unknown_speed: int = 30   # bucket of a view without a speed
    speed_cap: int = 35       # weight of slow views, and of views without a speed
    no_extension: str = "Extension_None"


def report(t: Tables, p: Params = Params()) -> DataFrame:
    markets = t["marketplaces"].select(F.col("id").alias("marketplace_id"), "region", F.col("country").alias("country_code"))
    # summed by all that the lookups need first: they meet groups instead of view rows
    views = t["speed_facts"].groupBy(*FACT_KEYS).agg(F.sum("gv_count").alias("gv_count")).join(markets, "marketplace_id")
    speed = F.coalesce("gvs_prod_int", F.lit(p.unknown_speed))
    bucketed = range_join(views, t["speed_buckets"], speed, "range_min", "range_max")
    clustered = bucketed.join(t["category_mapping"].select("category_desc", "semantic_cluster").distinct(),
                              "category_desc", "left")
    promised = specific_or_default(clustered, t["promise_extension"], "promise_extension", otherwise=p.no_extension)
    bossed = promised.join(t["boss_categories"], ["country_code", "gl_product_group", "category_code"], "left")
    return bossed.groupBy(
        "region", "country_code", F.col("fn_channel").alias("channel"), "gl_product_group", "wbr_gl_description",
        "wbr_gl_family", "in_country", "in_region",
        labels.cluster_bucket(F.col("semantic_cluster"), F.col("wbr_gl_family")).alias("gl_custom_group"),
        "promise_extension", F.coalesce("boss", F.lit("No")).alias("gl_boss_group"), "gvs",
        F.lit("").alias("category_desc"), "snapshot_day").agg(
        F.sum("gv_count").alias("gv_count"),
        F.sum(F.col("gv_count") * F.least("gvs_prod_int", F.lit(p.speed_cap))).alias("gvs_prod_sum"))
