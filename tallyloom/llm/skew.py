"""Left joins to a lookup whose keys may be very unequally frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many keys are broadcast: those that hold more than one row in ``HOT_KEYS`` of all.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, lookup: DataFrame, key: str, uid: str, total: int, count: str = "n") -> DataFrame:
    """``rows`` left join ``lookup`` on the text column ``key``; ``lookup`` has unique keys, and in ``count`` how many rows bear each.

    Keys with more than ``total / HOT_KEYS`` rows are fewer than ``HOT_KEYS`` and are joined by broadcast; the rows that found theirs
    are dealt by ``uid`` for the second join, so no key fills a task. Both frames should be scans of written tables.
    """
    hot = F.col(count) * HOT_KEYS > total
    values = [c for c in lookup.columns if c not in (key, count)]
    found = F.struct(*values)
    near = rows.join(F.broadcast(lookup.where(hot).select(key, found.alias("_hot"))), key, "left")
    apart = F.when(F.col("_hot").isNull(), F.concat(F.lit("="), F.col(key))).otherwise(F.concat(F.lit("~"), F.col(uid).cast("string")))
    far = lookup.where(~hot).select(F.concat(F.lit("="), F.col(key)).alias("_key"), found.alias("_cold"))
    both = near.withColumn("_key", apart).join(far, "_key", "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return both.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in values])
