"""Nearest neighbours by multiprobe p-stable hashing.

A table has ``functions`` hashes ``floor((a.v + b) / width)`` with Gaussian ``a``; a vector's bucket is the list of its hash
values. A query visits its own bucket and perturbed ones (some hash values one lower or higher) in the order of their
estimated success: the score of a perturbation is the sum of squared distances to the boundaries that it crosses. The
order of perturbation sets over the ranks of the sorted boundary distances is worked out once, from the expected
distances, and then mapped onto each query's own. Candidates of all tables are merged by vector and reranked by
the exact measure on the original vectors.

Nearness is the inner product. Vectors are dealt to bands of norms within a factor of two, each with tables of its own (norms are
handled as logarithms and vectors divided by their largest component first, so denormal and huge components neither vanish nor overflow); they
are scaled to the largest norm of their band and get one more component that fills them up to unit length (none for queries), so
that the largest inner product is the smallest distance. A query visits every band.

A query that meets fewer than ``k`` candidates (or than there are others) is compared with all rows, in blocks.

Every row is indexed. Buckets are dealt to cells by hash; a cell above ``cell_rows`` rows is split into blocks by a hash of
the row, so a hot bucket does not land in one task, and a query meets the rows of its visited buckets in every block.
The queries of a cell are dealt to blocks as well, so no task holds an unbounded side. A block gives at most ``k`` rows a
query, and these lists are merged in rounds, in groups of bounded numbers of queries and of lists. Equal scores are kept whole until the
tie is settled by the smaller id. Nothing is sampled.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do vectors of another
length than ``dim`` (default: the most frequent length, the longer of equals) or with a null id; a row that repeats an id is
a candidate once a distinct vector, with its best score; a product that overflows is infinite, and one that is no number ranks last; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.staging import stage

DIGIT = 64
#: Scores are first compared in single precision; what lies this close below the k-th, as a share of the norms, is reranked too.
CLOSE = 1e-5
#: Queries whose visits are listed at a time; queries, and lists of each, that are merged in one group.
VISITING = 64
MERGED_QUERIES, MERGED_LISTS = 512, 32
LISTS = "query_id bigint, list bigint, ids array<bigint>, scores array<double>"


def perturbations(functions: int, probes: int) -> np.ndarray:
    """``probes`` sets of ranks 1..2M of boundary distances, as 0/1 rows, in order of expected score; the first is empty.

    A set holds at most one of the two boundaries of a function, ranks ``j`` and ``2M + 1 - j``.
    """
    m = functions
    j = np.arange(1, m + 1)
    expected = np.concatenate([j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - j[::-1] / (m + 1) + j[::-1] * (j[::-1] + 1) / (4 * (m + 1) * (m + 2))])
    out, heap = [()], [(expected[0], (1,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        if all(2 * m + 1 - r not in chosen for r in chosen):
            out.append(chosen)
        last = chosen[-1]
        if last < 2 * m:
            heapq.heappush(heap, (score - expected[last - 1] + expected[last], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + expected[last], (*chosen, last + 1)))
    rows = np.zeros((len(out), 2 * m), bool)
    for i, chosen in enumerate(out):
        rows[i, [r - 1 for r in chosen]] = True
    return rows


class Hashes:
    """The hash functions of all tables, from a seed."""

    def __init__(self, dim: int, tables: int, functions: int, width: float, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.tables, self.functions, self.width = tables, functions, width
        self.a = rng.standard_normal((tables, dim + 1, functions))
        self.b = rng.uniform(0, width, (tables, functions))

    def places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """``vectors`` (with their last component) as real positions; the integer part is the hash value."""
        return (np.einsum("nd,df->nf", vectors, self.a[table]) + self.b[table]) / self.width

    def code(self, values: np.ndarray) -> np.ndarray:
        """One number for a bucket; values beyond +-32 widths share the last."""
        return (np.clip(values, -DIGIT // 2, DIGIT // 2 - 1).astype(np.int64) + DIGIT // 2) @ (DIGIT ** np.arange(self.functions, dtype=np.int64))

    def probes(self, places: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """Codes of one query's visited buckets, most promising first."""
        m, base = self.functions, np.floor(places)
        inside = places - base
        distance = np.concatenate([inside, 1 - inside])  # to the lower and to the upper boundary
        order = np.argsort(distance, kind="stable")
        move = np.zeros((2 * m, m), np.int64)
        move[np.arange(2 * m), order % m] = np.where(order < m, -1, 1)
        return self.code(base.astype(np.int64) + sets @ move)


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats travel as floats
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(sound, F.lit(False)))


def _log_norm():
    """Binary logarithm of the norm, finite for every vector that takes part."""
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    squares = F.aggregate(F.transform(F.array(largest), lambda m: F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + (x.cast("double") / m) * (x.cast("double") / m))), F.lit(0.0), lambda a, x: a + x)
    return F.log2(largest) + F.log2(squares) / 2


def _band(largest: float):
    """How often the norm can be doubled without passing the largest."""
    return F.greatest(F.floor(F.lit(largest) - F.col("log_norm")), F.lit(0)).cast("int")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", dim: int | None = None,
            tables: int = 3, functions: int = 6, width: float = 2.0, probes: int = 128, cell_rows: int = 4096) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest found of every query row, itself left out.

    ``is_query`` is a condition on the column ``id``. ``width`` is in units of the largest norm of a band.

    The defaults suit vectors without any structure, whose 20th neighbour is hardly nearer than a random vector; such data
    make every index visit a large part of all buckets. Clustered vectors need fewer probes.
    """
    rows = _valid(vectors, id_col, vector_col).withColumn("log_norm", _log_norm())
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries"), F.max("log_norm").alias("norm"))
    found = (lengths if dim is None else lengths.where(F.col("d") == dim)).orderBy(F.desc("n"), F.desc("d")).first()
    spark = vectors.sparkSession
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    dim, norm = found.d, found.norm
    rows = rows.where(F.size("v") == dim).withColumn("band", _band(norm))
    bands = {r.band: r.norm for r in rows.groupBy("band").agg(F.max("log_norm").alias("norm")).collect()}  # one number for each power of two in use
    numbers = {b: i for i, b in enumerate(sorted(bands))}
    kind = rows.schema["v"].dataType.simpleString()
    hashes, sets = Hashes(dim, tables, functions, width), perturbations(functions, probes)
    cells = max(1, -(-found.n // cell_rows))

    def filled(v: pd.Series, shorter: np.ndarray | None = None) -> np.ndarray:
        """Queries at unit length; index rows ``2 ** shorter`` times as long as the longest of their band, filled up to unit length."""
        x = _scaled(np.stack(v.to_numpy()).astype(float))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        if shorter is not None:
            x *= np.exp2(shorter)[:, None]
        rest = np.zeros(len(x)) if shorter is None else np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    def cell(codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) % np.uint64(cells)).astype(np.int32)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = filled(b["v"], np.minimum(0, b["log_norm"].to_numpy() - b["band"].map(bands).to_numpy()))
            number = b["band"].map(numbers).to_numpy()
            for t in range(tables):
                codes = hashes.code(np.floor(hashes.places(x, t)))
                yield pd.DataFrame({"t": (number * tables + t).astype(np.int32), "cell": cell(codes), "code": codes, "id": b["id"], "v": b["v"]})

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), VISITING):
                part = b.iloc[start:start + VISITING]
                x = filled(part["v"])
                for t in range(tables):
                    out = []
                    for i, place in enumerate(hashes.places(x, t)):
                        codes = np.unique(hashes.probes(place, sets))
                        at = cell(codes)
                        out += [(number * tables + t, c, part["id"].iat[i], part["v"].iat[i], codes[at == c]) for c in np.unique(at) for number in numbers.values()]
                    yield pd.DataFrame(out, columns=["t", "cell", "query_id", "q", "codes"])

    indexed = rows.mapInPandas(index, f"t int, cell int, code bigint, id bigint, v {kind}")
    asked = rows.where(is_query).mapInPandas(visits, f"t int, cell int, query_id bigint, q {kind}, codes array<bigint>")
    indexed, asked = (stage(df, "ann") for df in (indexed, asked))
    blocks = lambda n: F.greatest(F.ceil(n / cell_rows), F.lit(1)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def compare(index_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(index_rows) or not len(query_rows):
            return pd.DataFrame(out, columns=["query_id", "list", "ids", "scores"])
        number = sum(int(index_rows[c].iat[0]) << shift for c, shift in (("t", 44), ("cell", 16), ("rb", 0)))
        x, ids = np.stack(index_rows["v"].to_numpy()).astype(float), index_rows["id"].to_numpy()
        x_unit = x / np.abs(x).max()
        rough = (x_unit / np.linalg.norm(x_unit, axis=1).max()).astype(np.float32).T.copy()
        codes, at = np.unique(index_rows["code"].to_numpy(), return_inverse=True)
        for start in range(0, len(query_rows), 256):
            part = query_rows.iloc[start:start + 256]
            q, qid = np.stack(part["q"].to_numpy()).astype(float), part["query_id"].to_numpy()
            unit = q / np.abs(q).max(axis=1, keepdims=True)
            close = CLOSE * np.linalg.norm(unit, axis=1, keepdims=True).astype(np.float32)
            visited = np.stack([np.isin(codes, c, assume_unique=True) for c in part["codes"]])
            scores = np.where(visited[:, at] & (qid[:, None] != ids[None, :]), unit.astype(np.float32) @ rough, np.float32(-np.inf))
            if scores.shape[1] > k:
                least = np.partition(scores, -k, axis=1)[:, -k][:, None] - close
            else:
                least = np.full((len(q), 1), np.float32(-np.inf))
            i, j = np.nonzero((scores >= least) & (scores > -np.inf))  # every tie and near tie goes to the exact measure
            with np.errstate(over="ignore", invalid="ignore"):
                exact = (q[i] * x[j]).sum(axis=1)
            order = np.lexsort((ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            cuts = np.flatnonzero(np.diff(i)) + 1
            out += [(qid[rows[0]], number, n[:k], e[:k]) for rows, n, e in zip(*(np.split(c, cuts) for c in (i, ids[j], exact))) if len(rows)]
        return pd.DataFrame(out, columns=["query_id", "list", "ids", "scores"])

    def best(lists: pd.DataFrame) -> pd.DataFrame:
        sizes = lists["ids"].map(len)
        each = pd.DataFrame({"query_id": np.repeat(lists["query_id"].to_numpy(), sizes), "id": np.concatenate(lists["ids"].to_numpy()),
                             "score": np.concatenate(lists["scores"].to_numpy())})
        each = each.sort_values(["query_id", "score", "id"], ascending=[True, False, True]).drop_duplicates(["query_id", "id"])
        each = each[each.groupby("query_id").cumcount() < k]
        return each.groupby("query_id").agg(ids=("id", list), scores=("score", list)).reset_index().assign(list=lists["part"].iat[0])

    def merge(lists: DataFrame, blocks: int) -> DataFrame:
        groups, parts = max(1, -(-found.queries // MERGED_QUERIES)), blocks
        while True:  # each round leaves one list a query of MERGED_LISTS of them; no group holds more
            parts = -(-parts // MERGED_LISTS)
            keyed = lists.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups))).withColumn("part", F.pmod(F.xxhash64("list"), F.lit(parts)))
            lists = keyed.groupBy("g", "part").applyInPandas(best, LISTS)
            if parts <= 1:
                break
        each = F.posexplode(F.arrays_zip("ids", "scores"))
        score = F.coalesce("e.scores", F.lit(float("nan")))  # pandas passes what is no number as null
        return lists.select("query_id", each.alias("rank", "e")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("e.ids").alias("id"), score.alias("score"))

    def answers(indexed: DataFrame, asked: DataFrame) -> DataFrame:
        """The nearest among the rows of the visited buckets."""
        sizes = stage(indexed.groupBy("t", "cell").agg(blocks(F.count(F.lit(1))).alias("row_blocks"))
                      .join(asked.groupBy("t", "cell").agg(blocks(F.count(F.lit(1))).alias("query_blocks")), ["t", "cell"]), "cells")
        left = (indexed.join(sizes, ["t", "cell"]).withColumn("rb", F.pmod(F.hash("id", "code"), "row_blocks"))
                .withColumn("qb", every("query_blocks")).drop("row_blocks", "query_blocks"))
        right = (asked.join(sizes, ["t", "cell"]).withColumn("qb", F.pmod(F.hash("query_id"), "query_blocks"))
                 .withColumn("rb", every("row_blocks")).drop("row_blocks", "query_blocks"))
        keys = ["t", "cell", "rb", "qb"]
        near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, LISTS)
        return merge(near, sizes.agg(F.sum("row_blocks").alias("n")).first().n or 1)

    reached = stage(answers(indexed, asked), "nearest")
    others = rows.select("id").distinct().limit(k + 1).count() - 1
    whole = reached.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, others)).select("query_id")
    short = stage(rows.where(is_query).select(F.col("id").alias("query_id"), F.col("v").alias("q")).join(whole, "query_id", "left_anti"), "short")
    if others < 1 or short.isEmpty():
        return reached
    # one bucket holds all rows, dealt to cells by their id; every query visits each cell
    many = rows.select(F.lit(0).alias("t"), F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int").alias("cell"), F.lit(0).cast("long").alias("code"), "id", "v")
    all_cells = short.select(F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "query_id", "q",
                             F.array(F.lit(0).cast("long")).alias("codes"))
    return reached.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(answers(many, all_cells))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the 20 nearest found of every vector whose id is divisible by 20, among all other vectors."""
    found = nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
