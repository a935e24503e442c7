import hashlib
import math
from itertools import groupby

import duckdb
import numpy as np
import pytest

from tallyloom.llm import op12_centroids as op
from tests.compare import same_rows

KIND = "vec_id bigint, embedding array<double>, label int"


def brute(rows, clusters=8, rounds=10, dim=64, scale=1024, prefix="3:"):
    """Rows of the query, with Python's whole numbers and no products kept."""
    most = op.largest(dim) // scale
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) <= most for x in v)]
    digest = lambda i: hashlib.sha256(f"{prefix}{i}".encode()).hexdigest()
    centroids = [v for i, v in sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:clusters]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))

    def assign():
        return [min((apart(v, c), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        by = sorted(zip((j for _, j in assign()), (v for _, v in kept)))
        for j, members in groupby(by, key=lambda x: x[0]):
            members = [v for _, v in members]
            centroids[j] = [sum(c) // len(members) for c in zip(*members)]
    near = assign()
    own = lambda j: sum(d for d, k in near if k == j)
    hashed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, own(j), sum(d for d, _ in near), hashed[j]) for (i, _), (d, j) in zip(kept, near)), key=str)


def write(spark, rows, folder):
    spark.createDataFrame(rows, KIND).withColumnsRenamed({"label": "cluster"}).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark, sf_dir, duck):
    assert same_rows(op.query(spark, sf_dir), duck, op.SQL) > 0
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert got(op.query(spark, sf_dir)) == brute(rows)


def test_awkward(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=64)], i) for i in range(40)]
    rows += [rows[0], (1, rows[2][1], 0), (None, rows[3][1], None), (100, None, 1), (101, [], 1), (102, [1.0] * 63, 1), (103, [1.0] * 63 + [None], 1),
             (104, [1.0] * 63 + [float("nan")], 1), (105, [float("-inf")] + [0.0] * 63, 1), (106, [0.0] * 64, 1), (107, [-0.0] * 64, 1),
             (108, [1e-300, -1e-300] * 32, 1), (109, [100_000.0, -100_000.0] * 32, 1), (110, [1e300] * 64, 1)]
    sf = write(spark, rows, tmp_path)
    want = brute([r[:2] for r in rows])
    assert got(op.query(spark, sf)) == want and len(want) == 47
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet/*.parquet') WHERE vec_id IS DISTINCT FROM 110")
        assert same_rows(op.query(spark, sf), con, op.SQL) == 47


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_clusters(spark, tmp_path, n):
    rows = [(i, [float(i)] * 64, 0) for i in range(n)]
    df = op.query(spark, write(spark, rows, tmp_path))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got(df) == brute([r[:2] for r in rows]) and len(got(df)) == n


def test_kept_products_are_exact(spark):
    """After any number of rounds the products that are kept are those with the last centroids, and a cluster may fall empty."""
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(3, 5)) * 9
    rows = [(i, [float(x) for x in centre[i % 3] + rng.normal(size=5)], 0) for i in range(200)] + [(500, [0.0] * 5, 0), (501, [0.0] * 5, 0)]
    df = spark.createDataFrame(rows, KIND)
    for rounds in (0, 1, 4, 30):
        found, centroids = op.cluster(df, clusters=6, rounds=rounds, dim=5, scale=100, prefix="x")
        for r in found.collect():
            assert r.dots == [int(np.dot(r.v, c)) for c in centroids]
        want = brute([r[:2] for r in rows], 6, rounds, 5, 100, "x")
        assert sorted((r.id, r.cluster, r.distance) for r in found.collect()) == sorted(w[:3] for w in want)


def test_only_moved_components_count():
    v = np.arange(12).reshape(3, 4)
    old, new = np.array([[1, 2, 3, 4], [5, 6, 7, 8]]), np.array([[1, 2, 3, 4], [5, -6, 7, 9]])
    dots = v @ old.T
    assert (op.moved(dots, v, old, new) == v @ new.T).all() and (dots == v @ old.T).all()
