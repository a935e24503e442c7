"""Joins that need more than ``df.join``: rates, wildcards, fallbacks, ranges, prior years, pairs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar


def rates_of(fx: DataFrame, scenario: str | Column, target: str = "US",
             countries: Sequence[str] | None = None) -> DataFrame:
    """``country_code, fx_rate, scenario`` of one scenario, given by name or as a scalar subquery."""
    rows = fx.filter((F.col("target_country_code") == target) & (F.col("scenario") == scenario))
    if countries is not None:
        rows = rows.filter(F.col("source_country_code").isin(*countries))
    return rows.select(F.col("source_country_code").alias("country_code"), "fx_rate", "scenario")


def with_rate(df: DataFrame, rates: DataFrame, how: str = "inner") -> DataFrame:
    """Attach ``fx_rate``: inner drops countries without a rate, left leaves NULL."""
    return df.join(rates.select("country_code", "fx_rate"), "country_code", how)


def wildcard_left(df: DataFrame, lookup: DataFrame, keys: Sequence[str], wildcard: str,
                  values: Sequence[str]) -> DataFrame:
    """Left join where a NULL ``wildcard`` in the lookup stands for any (known) value.

    A fact row whose own value is NULL finds nothing; an exact row and a wildcard row both match, and
    then the fact row is returned twice.
    """
    named = lookup.select(*[F.col(k).alias(f"_{k}") for k in keys],
                          F.col(wildcard).alias("_any"), *values)
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    hit = F.col(wildcard) == F.coalesce(F.col("_any"), F.col(wildcard))
    condition = hit
    for part in reversed(same):
        condition = part & condition
    return df.join(named, condition, "left").drop("_any", *[f"_{k}" for k in keys])


def specific_or_default(df: DataFrame, lookup: DataFrame, value: str, country: str = "country_code",
                        product: str = "gl_product_group", category: str = "category_code",
                        default_product: int = 0, otherwise: str | None = None) -> DataFrame:
    """Value for the product (and category), else the country's default, else a constant.

    The default of a country is the lookup row of ``default_product``.
    """
    default = (lookup.filter(F.col(product) == default_product)
               .select(F.col(country), F.col(value).alias("_default")))
    specific = lookup.withColumnRenamed(value, "_specific")
    choice = [F.col("_specific"), F.col("_default")]
    if otherwise is not None:
        choice.append(F.lit(otherwise))
    found = wildcard_left(df, specific, (country, product), category, ["_specific"])
    return (found.join(default, country, "left")
            .withColumn(value, F.coalesce(*choice)).drop("_specific", "_default"))


#: Levels of the tree of a range join, at most.
MOST_LEVELS = 40


def range_nodes(ranges: DataFrame, low: str, high: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``ranges`` once for each node of a binary tree that stands for a part of it (``_level``, ``_node``), and the slot of a value.

    The values from the smallest to the largest start are cut into about as many slots of equal width as there are ranges, the last one without an
    end, and the tree is laid over the slots. The nodes of a range are the largest that lie within its slots, at most two a level, so a range of any
    length, with or without an end, makes ``2 log n`` rows at most. No two of them share a slot.
    """
    starts = ranges.agg(F.min(low).alias("least"), F.max(low).alias("most"), F.count(low).alias("n")).first()
    least, most = int(starts["least"] or 0), int(starts["most"] or 0)
    levels = min(MOST_LEVELS, max(0, (starts["n"] or 1) - 1).bit_length())
    width = max(1, -(-(most - least + 1) // (1 << levels)))
    top = (1 << levels) - 1

    def slot(c: Column) -> Column:
        return F.least(F.greatest(F.floor((c.cast("double") - least) / width), F.lit(0)), F.lit(top)).cast("long")

    level = F.col("_level")
    whole = _down(F.lit(top).cast("long"), F.lit(levels) - level)  # slots of a node, less one
    spread = (ranges.filter(F.col(low) <= F.col(high)).withColumn("_from", slot(F.col(low))).withColumn("_to", slot(F.col(high)))
              .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
              # the first and the last node of a level that lie within the range
              .withColumn("_first", _down(F.col("_from") + whole, level)).withColumn("_last", _down(F.col("_to") + 1, level) - 1)
              .filter(F.col("_first") <= F.col("_last")))
    # a node is left out where the node above it lies within the range as well
    first = (F.col("_first") % 2 == 1) | (F.col("_first") == F.col("_last"))
    last = (F.col("_last") % 2 == 0) & (F.col("_last") != F.col("_first"))
    nodes = F.array_compact(F.array(F.when(first, F.col("_first")), F.when(last, F.col("_last"))))
    return spread.withColumn("_node", F.explode(nodes)).drop("_from", "_to", "_first", "_last"), slot


def _down(c: Column, bits: Column) -> Column:
    return F.call_function("shiftright", c, bits)


def range_join(df: DataFrame, ranges: DataFrame, value: Column, low: str, high: str) -> DataFrame:
    """Inner join on ``value BETWEEN low AND high`` as an equi join on :func:`range_nodes`.

    A value looks in the nodes above its slot, on the levels that any range uses, and meets each matching range in exactly one of them; the bounds are
    compared there, as slots are wider than values. Integer or decimal values both work; a range with a NULL bound matches nothing.
    """
    spread, slot = range_nodes(ranges, low, high)
    used = sorted(r[0] for r in spread.select("_level").distinct().collect())  # MOST_LEVELS + 1 numbers at most
    probe = df.withColumn("_value", value).withColumn("_slot", slot(F.col("_value")))
    probe = probe.withColumn("_level", F.explode(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")))
    probe = probe.withColumn("_node", _down(F.col("_slot"), F.col("_level"))).drop("_slot")
    return (probe.join(spread, ["_level", "_node"])
            .filter(F.col("_value").between(F.col(low), F.col(high)))
            .drop("_level", "_node", "_value", low, high))


def beside_prior_year(rows: DataFrame, day: str, keys: Sequence[str], measures: Mapping[str, Column],
                      current: Column, prior: Column, suffixes: tuple[str, str] = ("cy", "py")) -> DataFrame:
    """Aggregate each current day next to its partner day one planning year earlier.

    Partners share planning week and weekday, and their planning years differ by one, so
    (year, week, weekday) names a single day. Current and prior rows are therefore tagged with the
    current day's key and summed side by side in one aggregation: one exchange, no join. Days without
    current rows are dropped, days without prior rows keep NULL (as a left join would). As in a join, a
    NULL key has no partner. A row may be current and prior at once.
    """
    cy, py = suffixes
    d = F.col(day)
    for key in keys:
        prior = prior & F.col(key).isNotNull()
    # constant arrays: the row is repeated inside generated code, without a lambda per row
    shifts = (F.when(current & prior, F.array(F.lit(0), F.lit(1)))
              .when(current, F.array(F.lit(0))).when(prior, F.array(F.lit(1))))
    tagged = (rows.filter(current | prior)
              .withColumn("year", calendar.planning_year(d))
              .withColumn("week", calendar.planning_week(d))
              .withColumn("dow", calendar.weekday(d))
              .withColumn("_shift", F.explode(shifts))
              .withColumn("year", F.col("year") + F.col("_shift")))
    is_prior = F.col("_shift") == 1
    sums = [F.sum(F.when(~is_prior, m)).alias(f"{n}_{cy}") for n, m in measures.items()]
    sums += [F.sum(F.when(is_prior, m)).alias(f"{n}_{py}") for n, m in measures.items()]
    return (tagged.groupBy(*keys, "year", "week", "dow")
            .agg(F.max(F.when(~is_prior, d)).alias("target_day"), *sums)
            .filter(F.col("target_day").isNotNull()))


def full_pair(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join with merged keys; NULL keys never match, their rows stay on their own side."""
    return left.join(right, list(keys), "full")
