"""Source divergence audit: which terms set a source apart from its language, found through dominance skybands.

Every (language, source) group and every language gives each term that the language keeps a smoothed share
``p = 1 + floor(1000000000 * (count + smoothing) / (N + smoothing * V))``, with whole numbers only. Two reports come from them: the
distance of a group to every other group of its language (sum of ``|p - q|`` over the kept terms), and the terms by which a group
exceeds its language most.

**Terms.** ``p`` grows with the count in the group, ``q`` with the count in the language, and equal differences are ranked by
UTF-8. A term with a higher or equal group count, a lower or equal language count and an earlier name therefore ranks before
the term that it dominates, whatever ``N`` and ``V`` are. What ``k`` others dominate cannot be among the first ``k``. Terms of a group are
dealt to parts; each part retains its k-skyband (terms dominated by fewer than ``k`` others of the part), skybands are merged
and thinned again while that makes parts fewer, and only what is left is ranked exactly. It is enough to count dominators that
are retained themselves: the first ``k`` dominators of a term, in the order of processing, are.

**Pairs.** Terms are dealt to slices of about ``SLICE`` terms and the sources of a language to blocks of ``BLOCK``; a task holds the counts of one slice
for two blocks and adds up what they differ from the distance of two empty groups, which is known without any term. Nothing grows
with the number of terms or sources but the number of tasks; the pairs themselves are the result.

Texts are counted in the tasks that read them (map-side sums are flushed at a bound), so a hot source or copied text is summed
before any exchange; document counts add up because a document is counted where it is read.

Defined results: null text, language and source count as empty; a text without terms still makes its group occur; repeated rows
count as often as they occur; languages are compared as they are written; further columns are ignored; an empty table gives an
empty result. A language without kept terms has pairs of value 0 and no terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloom.operators.staging import stage

#: Terms are runs of ASCII letters and of all signs beyond ASCII; only A-Z are lower-cased. On UTF-8 bytes: what is no term byte becomes a space.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
FLUSH = 80_000
SLICE = 2048
BLOCK = 256
PART_ROWS = 8192
MERGED_ROWS = 65_536


@dataclass(frozen=True)
class Audit:
    """Which terms count, and how shares are smoothed and reported."""

    least_documents: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    terms: int = 50


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                flush_at: int = FLUSH) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents; each group has one row with a null term besides."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    rows = docs.select(*named, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw"))
    names = ["lang", "source", "term", "n", "docs"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                terms = [None, *(t.decode() for t in n)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                                                  pa.array(terms, pa.string()), pa.array([0, *n.values()], pa.int64()),
                                                  pa.array([0, *map(docs.__getitem__, n)], pa.int64())], names)
            groups.clear()

        held = 0
        for batch in batches:
            for lang, source, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, in_docs = groups.setdefault((lang, source), (Counter(), Counter()))
                terms = raw.as_py().translate(TERM_BYTES).split()
                held -= len(n)
                n.update(terms)
                in_docs.update(set(terms))
                held += len(n)
                if held > flush_at:
                    yield from flush()
                    held = 0
        yield from flush()

    found = rows.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column, audit: Audit) -> Column:
    """``1 + floor(scale * (count + smoothing) / (total + smoothing * kept))`` in whole numbers; 0 without kept terms."""
    exact = lambda c: c.cast("decimal(18,0)")
    top = F.lit(audit.scale).cast("decimal(12,0)") * (exact(count) + F.lit(audit.smoothing).cast("decimal(6,0)"))
    below = exact(total) + F.lit(audit.smoothing).cast("decimal(6,0)") * exact(kept)
    return F.when(kept > 0, F.call_function("div", top, F.when(kept > 0, below)) + 1).otherwise(F.lit(0).cast("long"))


def skyband(n: np.ndarray, lang_n: np.ndarray, names: np.ndarray, k: int, chunk: int = 256) -> np.ndarray:
    """Positions of the terms that fewer than ``k`` others dominate."""
    place = np.empty(len(n), np.int64)
    place[np.array(sorted(range(len(n)), key=names.__getitem__), np.int64)] = np.arange(len(n))
    order = np.lexsort((place, lang_n, -n))  # who dominates a term comes before it
    kept = order[:0]
    for at in range(0, len(order), chunk):
        now = order[at:at + chunk]
        others = np.concatenate([kept, now])
        # a later or equal term of the chunk fails one of the tests, or is the term itself, whose name is not earlier
        over = (n[others] >= n[now][:, None]) & (lang_n[others] <= lang_n[now][:, None]) & (place[others] < place[now][:, None])
        kept = np.concatenate([kept, now[over.sum(axis=1) < k]])
    return kept


def _retained(rows: DataFrame, k: int) -> DataFrame:
    """The skybands of ``(group_id, part)`` among ``rows(group_id, parts, part, term, n, lang_n)``."""
    def thin(part: pd.DataFrame) -> pd.DataFrame:
        kept = skyband(part["n"].to_numpy(), part["lang_n"].to_numpy(), part["term"].to_numpy(), k)
        return part.iloc[kept][["group_id", "parts", "term", "n", "lang_n"]]

    return rows.groupBy("group_id", "part").applyInPandas(thin, "group_id bigint, parts bigint, term string, n bigint, lang_n bigint")


def candidates(rows: DataFrame, k: int, part_rows: int = PART_ROWS, merged_rows: int = MERGED_ROWS) -> DataFrame:
    """Terms that can be among the first ``k`` of their group, of ``rows(group_id, present, term, n, lang_n)``, by merged skybands.

    ``present`` is the number of the group's terms. Skybands are merged into as few parts of ``merged_rows`` as they fill, until
    the number of parts of no group falls any more.
    """
    part = F.pmod(F.xxhash64("term"), F.col("parts"))
    parts = lambda size, most: F.greatest(F.ceil(size / most), F.lit(1)).cast("long")
    dealt = rows.withColumn("parts", parts(F.col("present"), part_rows)).withColumn("part", part)
    left = stage(_retained(dealt, k), "skyband")
    done = None
    while True:
        sizes = left.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"), F.max("parts").alias("before"))
        merged = stage(sizes.withColumn("after", parts(F.col("size"), merged_rows)).where("after < before").select("group_id", "after"), "merged")
        if merged.isEmpty():
            return left if done is None else done.unionByName(left)
        rest = left.join(merged, "group_id", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        again = left.join(merged, "group_id").withColumn("parts", F.col("after")).withColumn("part", part)
        left = stage(_retained(again, k), "skyband")


def _beyond_empty(part: pd.DataFrame) -> pd.DataFrame:
    """What the terms of one slice add to the distances of the sources of two blocks, beside that of two empty groups."""
    sources = part[part["term_id"] < 0].drop_duplicates("group_id").sort_values("group_id")
    ids, empty, blocks = (sources[c].to_numpy() for c in ("group_id", "p", "block"))
    counted = part[part["term_id"] >= 0]
    terms, at = np.unique(counted["term_id"].to_numpy(), return_inverse=True)
    shares = np.tile(empty, (len(terms), 1))
    shares[at, np.searchsorted(ids, counted["group_id"].to_numpy())] = counted["p"].to_numpy()
    first, second = (np.flatnonzero(blocks == part[c].iat[0]) for c in ("one", "two"))
    out = []
    for i in first:
        others = second[ids[second] > ids[i]] if part["one"].iat[0] == part["two"].iat[0] else second
        value = np.abs(shares[:, [i]] - shares[:, others]).sum(axis=0) - len(terms) * np.abs(empty[i] - empty[others])
        out.append(pd.DataFrame({"a": ids[i], "b": ids[others], "value": value}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "value": []}, dtype="int64")


def _distances(rows: DataFrame, groups: DataFrame, slice_terms: int, block: int) -> DataFrame:
    """``(a, b, value)`` for both orders of every two groups of a language."""
    width = lambda size, most: F.greatest(F.ceil(size / most), F.lit(1)).cast("long")
    at_block = F.pmod(F.xxhash64("group_id"), F.col("blocks"))
    shaped = groups.withColumn("slices", width(F.col("kept"), slice_terms)).withColumn("blocks", width(F.col("sources"), block))
    shaped = shaped.withColumn("block", at_block).select("group_id", "lang_id", "slices", "blocks", "block", "empty")
    counted = (rows.select("group_id", "term_id", "p").join(shaped, "group_id")
               .withColumn("slice", F.pmod(F.xxhash64("term_id"), F.col("slices"))))
    marks = (shaped.withColumn("term_id", F.lit(-1).cast("long")).withColumn("p", F.col("empty"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))))
    both = (counted.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("lang_id", "slice", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "group_id", "term_id", "p"))
    added = (both.groupBy("lang_id", "slice", "one", "two").applyInPandas(_beyond_empty, "a bigint, b bigint, value bigint")
             .groupBy("a", "b").agg(F.sum("value").alias("added")))
    side = lambda c: groups.select(F.col("group_id").alias(c), F.col("empty").alias(f"empty_{c}"), *(["kept"] if c == "a" else []))
    value = F.col("added") + F.col("kept") * F.abs(F.col("empty_a") - F.col("empty_b"))
    found = added.join(side("a"), "a").join(side("b"), "b").select("a", "b", value.alias("value"))
    return found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))


def audit(docs: DataFrame, rules: Audit = Audit(), text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          slice_terms: int = SLICE, block: int = BLOCK, part_rows: int = PART_ROWS, merged_rows: int = MERGED_ROWS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for every group its distances (``pair``) and its leading terms (``term``)."""
    counts = stage(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = stage(counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                 .where(F.col("docs") >= rules.least_documents).select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")), "kept-terms")
    found = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "term_id", "n", "lang_n"), "kept-counts")
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("present"))
    occurring = counts.where("term IS NULL").select("lang", "source")
    langs = (occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
             .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
             .select("lang", F.monotonically_increasing_id().alias("lang_id"), "sources", F.coalesce("kept", F.lit(0)).alias("kept"),
                     F.coalesce("lang_total", F.lit(0)).alias("lang_total")))
    groups = occurring.join(stage(langs, "languages"), "lang").join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.monotonically_increasing_id().alias("group_id"), "lang_id", "sources", "kept", "lang_total",
        F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("present", F.lit(0)).alias("present"))
    groups = stage(groups.withColumn("empty", share(F.lit(0), F.col("total"), F.col("kept"), rules)), "groups")
    rows = found.join(groups.drop("sources", "empty"), ["lang", "source"])
    shares = rows.select("group_id", "term_id", share(F.col("n"), F.col("total"), F.col("kept"), rules).alias("p"))

    named = groups.select("group_id", "lang", "source")
    item = named.select(F.col("group_id").alias("b"), F.col("source").alias("item"))
    pairs = (_distances(shares, groups, slice_terms, block).join(item, "b").join(named.withColumnRenamed("group_id", "a"), "a")
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    leading = candidates(rows.select("group_id", "present", "term", "n", "lang_n"), rules.terms, part_rows, merged_rows).join(groups, "group_id")
    p, q = share(F.col("n"), F.col("total"), F.col("kept"), rules), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), rules)
    terms = leading.withColumn("value", p - q).where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by_rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(by_rank))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= rules.terms))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every group's distances to the other sources of its language, and its 50 leading terms, over all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
l AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.ln, l.v, l.lt,
        sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
    FROM g JOIN kept ON kept.lang = g.lang JOIN l ON l.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT *, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS BIGINT) AS p,
        CAST(1 + (1000000000 * CAST(ln + 5 AS HUGEINT)) // (lt + 5 * v) AS BIGINT) AS q FROM dense),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
    FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
