import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import op8_multiprobe as op


def brute(ids, x, queries, k=20):
    out = {}
    for q in queries:
        at = ids.index(q)
        scores = (x[at] * x).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(ids[i], scores[i]) for i in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_and_scores(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    got, hits = {}, 0
    for r in op.query(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id]) and r.vec_id != r.query_id
        assert r.score == pytest.approx(float(x[ids.index(r.query_id)] @ x[ids.index(r.vec_id)]), abs=1e-12)
    for q, best in want.items():
        assert len(got[q]) == 20 and [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        hits += len({i for i, _ in best} & {i for i, _ in got[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_hot_vector_ties_and_small_cells(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 8)).astype(float)
    x[100:300] = x[40]
    x[400:] *= 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in op.nearest(df, F.col("id") % 20 == 0, functions=2, probes=25, cell_rows=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    want = brute(list(range(600)), x, range(0, 600, 20))
    assert sum(len(set(got[q]) & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * 20 * len(want)
    near = op.nearest(df.where("vec_id < 300"), F.col("id") == 40, functions=2, probes=25, cell_rows=50).orderBy("rank").collect()
    best = [i for i, _ in brute(list(range(300)), x[:300], [40])[40]]
    assert [r.id for r in near] == best


def test_awkward_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (None, [1.0, 1.0], 1), (7, [1.0], 1), (20, [0.5, 0.5], None), (8, [], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({"id": F.lit(1), "v": F.lit("x"), "score": F.lit(2)})
    got = [(r.query_id, r.rank, r.id, r.score) for r in op.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert op.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_finite_components_of_any_size(spark):
    """Denormal, tiny and huge components take part; products may overflow to infinity, and one that is no number ranks last."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((60, 4))
    x[1], x[2], x[3], x[4] = [5e-324, 0, 0, 0], [1e-300, -1e-300, 0, 0], [1e200, 0, 0, 0], [1.7e308, 1.7e308, 0, 1.0]
    x[5], x[40] = [1e200, -1e200, 1e200, -1e200], [1e-200, 0, 0, 1e-200]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in op.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    with np.errstate(over="ignore", invalid="ignore"):
        for q, found in got.items():
            scores = (x[q] * x).sum(axis=1)
            best = sorted((i for i in range(60) if i != q), key=lambda i: (np.isnan(scores[i]), -scores[i], i))[:20]
            assert len(found) == 20 and len({i for i, _ in found} & set(best)) >= 18
            assert all(s == scores[i] or np.isnan(s) and np.isnan(scores[i]) for i, s in found)
        assert [i for i, _ in got[0]][:1] == [max((i for i in range(1, 60)), key=lambda i: ((x[0] * x[i]).sum(), -i))]
        huge = {r.id: r.score for r in op.nearest(df, F.col("id") == 5, k=59).collect()}
        assert len(huge) == 59 and np.isnan(huge[4]) and huge[3] == float("inf")
    only = op.nearest(df.where("vec_id IN (1, 2, 3)"), F.lit(True)).collect()
    assert len(only) == 6


def test_merging_in_rounds(spark, monkeypatch):
    """More lists a query than one group may hold: the result is that of one group."""
    x = np.random.default_rng(3).standard_normal((400, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = []
    for lists in (32, 2):
        monkeypatch.setattr(op, "MERGED_LISTS", lists)
        found.append(sorted(map(tuple, op.nearest(df, F.col("id") % 20 == 0, functions=2, probes=9, cell_rows=25).collect())))
    assert found[0] == found[1] and len(found[0]) == 400


def test_probe_order():
    sets = op.perturbations(4, 200)
    assert not sets[0].any() and len(sets) == 3**4  # each function: stay, down or up
    h = op.Hashes(5, 1, 4, 2.0)
    place = np.array([0.1, 0.5, 1.9, -3.2])
    codes = h.probes(place, sets)
    assert len(set(codes)) == 81 and codes[0] == h.code(np.floor(place)[None])[0]
    assert codes[1] in (h.code(np.floor(place)[None] + m)[0] for m in ([-1, 0, 0, 0], [0, 0, 1, 0]))


@pytest.mark.parametrize("n", [2, 10, 15, 30])
def test_tiny_tables_are_answered_whole(spark, n):
    x = np.random.default_rng(n).standard_normal((n, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in op.nearest(df, F.lit(True)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert set(got) == set(range(n)) and all(len(v) == min(20, n - 1) for v in got.values())
    if n <= 21:
        assert got == {q: [i for i, _ in w] for q, w in brute(list(range(n)), x, range(n)).items()}


@pytest.mark.parametrize("times", [10, 100])
def test_a_long_outlier_keeps_recall(spark, times):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    x[7] *= times
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in op.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    assert all(len(got[q]) == 20 for q in want)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * 20 * len(want)
