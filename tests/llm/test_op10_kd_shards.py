import random
import zlib

from pyspark.sql import functions as F

from tallyloom.llm import op10_kd_shards as op
from tests.llm.tables import awkward_documents, empty_documents, write


def check(rows, texts, shards, spread):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())
    sizes = [sum(r.size for r in by.get(i, ())) for i in range(shards)]
    assert len(by) <= shards and max(sizes) - min(sizes) <= spread, sizes


def test_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = op.query(spark, sf).collect()
    leaf = sum(len(r.text.encode()) + 16 for r in docs) / 40
    check(rows, [tuple(r) for r in docs], 40, 0.03 * leaf)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_leaves_are_boxes_of_metadata(spark):
    """With distinct coordinates a k-d tree of two leaves is the weighted median along the widest dimension."""
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("text"),
                                  F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    got = {r.doc_id: r.shard for r in op.shard(df, 2, dimensions=("source", "n_chars")).collect()}
    edge = sum(s == 0 for s in got.values())
    assert all(s == (0 if i < edge else 1) for i, s in got.items())
    sizes = [sum(16 + i % 7 for i, s in got.items() if s == k) for k in (0, 1)]
    assert abs(sizes[0] - sizes[1]) <= 50


def test_tree_over_several_dimensions(spark):
    """From the leaves back to the root: each node's two sides are apart along its widest dimension, and share its bytes as its leaves are shared."""
    rng, n, shards = random.Random(8), 900, 11
    points = [(rng.randint(0, 4000), rng.randint(0, 900), rng.choice([0, 5, 4095])) for _ in range(n)]
    points[0], points[1] = (0, 0, 0), (4095, 4095, 4095)  # so that a coordinate is its own scale of 12 bits
    df = spark.createDataFrame([(i, "x" * rng.randint(0, 40), *p) for i, p in enumerate(points)], "doc_id int, text string, a int, b int, c int")
    rows = {r.doc_id: r for r in op.shard(df, shards, dimensions=("a", "b", "c")).collect()}
    leaf_bytes, largest = sum(r.size for r in rows.values()) / shards, max(r.size for r in rows.values())

    def node(ids, first, leaves):
        assert {rows[i].shard for i in ids} <= set(range(first, first + leaves))
        if leaves == 1:
            return
        half = leaves // 2
        left = [i for i in ids if rows[i].shard < first + half]
        right = [i for i in ids if rows[i].shard >= first + half]
        width = [max(points[i][d] for i in ids) - min(points[i][d] for i in ids) for d in range(3)]
        d = width.index(max(width))
        assert max(points[i][d] for i in left) <= min(points[i][d] for i in right)
        goal = sum(rows[i].size for i in ids) * half / leaves
        assert abs(sum(rows[i].size for i in left) - goal) <= op.TOLERANCE * leaf_bytes + largest
        node(left, first, half)
        node(right, first + half, leaves - half)

    node(list(rows), 0, shards)


def test_hot_value_and_equal_rows_split(spark):
    df = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"), F.lit("hot").alias("source"),
                                  F.lit("en").alias("lang"), F.lit(9).alias("n_chars"))
    counts = [r["count"] for r in op.shard(df, 7).groupBy("shard").count().collect()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 8


def test_awkward_and_empty(spark, tmp_path):
    docs = awkward_documents(spark).where("doc_id IS NOT NULL")
    rows = op.query(spark, write(docs, tmp_path)).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 40, 10**9)
    assert op.shard(awkward_documents(spark), target_bytes=100_000).count() == 11
    assert op.shard(empty_documents(spark), 40).count() == 0
