"""Centroid clustering in whole numbers, with an incremental distance matrix.

Components become integers, ``floor(scale * x)``. For every vector the exact dot products with all centroids are kept, beside the
vector and its squared length, in a table. A round reads that table, adds ``(new - old) . v`` to the product of each centroid that has moved, over the
components in which it has moved only, takes the smallest ``|v|^2 - 2 v.c + |c|^2`` (ties: the smaller number) and writes the table
again. The first round starts from centroids of zeros and products of zero, so nothing is ever computed in another way. Then every
centroid with members is replaced by the floor of their componentwise mean, from sums that are exact. Rounds end early when no
centroid moves: the rest would change nothing.

The driver sees one row of sums a cluster and round (``clusters * dim`` numbers, whatever the number of vectors); vectors are
not shuffled at all. A round reads one written table and writes another, so a lost executor repeats part of a round; the table before
the last is removed.

Start: the vectors with the smallest SHA-256 of a prefix and their id, in that order (ties: by components).

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part; nor do those with a component whose
integer passes :func:`largest` in size, because squared distances could leave 64 bits. A null id takes part, but starts no centroid
unless ids run out; repeated rows are vectors of their own. Fewer vectors than clusters give that many clusters; an empty table
gives an empty result. An inertia beyond 64 bits is null. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.staging import staging_folder
from tallyloom.sources import files


def largest(dim: int) -> int:
    """The size of an integer up to which squared distances of ``dim`` components stay below 2**63 (2**27 for 64)."""
    return min(math.isqrt((1 << 62) // dim) // 2, (1 << 31) - 1)


def integers(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, v)`` of the vectors that take part, in whole numbers."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.size("x") == dim)
    sound = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= float(largest(dim) // scale)))
    return rows.where(F.coalesce(sound, F.lit(False))).select("id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))


def first_centroids(rows: DataFrame, clusters: int, prefix: str) -> np.ndarray:
    """The vectors that start the clusters, one a row."""
    by_hash = F.asc_nulls_last(F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256))
    found = rows.orderBy(by_hash, "v").select("v").limit(clusters).collect()
    return np.array([r.v for r in found], np.int64)


def moved(dots: np.ndarray, vectors: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Dot products with ``new`` centroids from those with ``old`` ones, by the components that differ."""
    dots = dots.copy()
    for j, change in enumerate(new - old):
        at = np.flatnonzero(change)
        if len(at):
            dots[:, j] += vectors[:, at] @ change[at]
    return dots


def _update(rows: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """One round over ``rows(id, v, square, dots, ...)``: products with ``new``, and the nearest centroid."""
    k, squares = len(new), (new * new).sum(axis=1)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            flat = lambda i, width: batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, width)
            v, square = flat(1, new.shape[1]), batch.column(2).to_numpy()
            dots = moved(flat(3, k), v, old, new)
            distance = square[:, None] - 2 * dots + squares
            cluster = distance.argmin(axis=1)
            ends = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.ListArray.from_arrays(ends, pa.array(dots.ravel())),
                                              pa.array(cluster.astype(np.int32)), pa.array(distance[np.arange(n), cluster])],
                                             ["id", "v", "square", "dots", "cluster", "distance"])

    return rows.select("id", "v", "square", "dots").mapInArrow(run, f"id {kind}, v array<int>, square bigint, dots array<bigint>, cluster int, distance bigint")


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, prefix: str = "3:",
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``(id, v, dots, cluster, distance)`` of every vector that takes part, and the final centroids, one a row."""
    spark = vectors.sparkSession
    rows = integers(vectors, dim, scale, id_col, vector_col)
    new = first_centroids(rows, clusters, prefix)
    k = len(new)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, c: a + c.cast("long") * c.cast("long"))
    state = rows.select("id", "v", square.alias("square"), F.array_repeat(F.lit(0).cast("long"), k).alias("dots"))
    if not k:
        return state.select("id", "v", "dots", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), new
    old, written = np.zeros_like(new), []
    for done in range(rounds + 1):
        path = staging_folder(spark, "centroid-round")
        out = _update(state, old, new)
        out.write.parquet(path)
        state = spark.read.schema(out.schema).parquet(path)
        written.append(path)
        if len(written) > 1:
            files.remove(spark, written.pop(0))  # its only reader was the round just written
        if done == rounds:
            break
        sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(dim)]).collect()
        old, new = new, new.copy()
        for r in sums:
            new[r.cluster] = [r[f"s{i}"] // r.n for i in range(dim)]
        if (new == old).all():
            break
    return state.select("id", "v", "dots", "cluster", "distance"), new


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: ten rounds over all embeddings of 64 components; cluster, distance, inertia and a digest of the centroid."""
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = {r.cluster: int(r.own) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    listed = [(j, fits(sums[j]), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j in sums]
    of_cluster = spark.createDataFrame(listed, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")  # one row a cluster
    return found.join(F.broadcast(of_cluster), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(clusters: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, prefix: str = "3:") -> str:
    """The query in SQL: every round as two CTEs, the distances of all vectors and the means of their clusters."""
    steps = [f"""WITH raw AS (SELECT row_number() OVER () AS k, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
kept AS MATERIALIZED (SELECT k, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM raw),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{prefix}' || vec_id), v) - 1 AS INTEGER) AS j, v AS c FROM kept
    WHERE vec_id IS NOT NULL QUALIFY j < {clusters})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT k, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS distance, arg_min(j, (d, j)) AS cluster
    FROM (SELECT k, vec_id, v, j, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, c{r}) GROUP BY k)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT cluster, i, sum(x) AS s, count(*) AS n
    FROM (SELECT cluster, unnest(v) AS x, unnest(range({dim})) AS i FROM a{r}) GROUP BY cluster, i),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(w.c, c.c) AS c FROM c{r} c LEFT JOIN
    (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM m{r} GROUP BY cluster) w ON w.cluster = c.j)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON j = cluster"""


SQL = sql()
