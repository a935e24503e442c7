import random

import numpy as np
import xxhash

from tallyloom.llm import op7_simhash as op
from tests.llm.tables import awkward_documents, empty_documents


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r.text) for r in docs]
    roots = brute_components(fps)
    want = {(d.doc_id, f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, roots)}
    assert {tuple(r) for r in op.query(spark, sf_dir).collect()} == want


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    got = op.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[1] == {(by[1].copy().pop()[0], 1)} and {c for _, c in by[7]} == {1}
    assert by[2] == by[3] == by[4] == {(0, 2)} and (0, 2) in by[None]
    assert {c for _, c in by[6]} == {5}
    assert op.near_duplicates(empty_documents(spark)).count() == 0


def test_index_covers_every_pair():
    masks = op.index_masks(3)
    assert len(masks) == 14 and all(m.bit_count() == 32 for m in masks)
    rng = random.Random(1)
    for bits in range(8):
        for _ in range(200):
            differ = sum(1 << i for i in rng.sample(range(64), bits))
            assert any(not m & differ for m in op.index_masks(bits))
            assert all(any(not x & differ for x in op.finer_masks(m, bits)) for m in op.index_masks(bits) if not m & differ)


def test_long_lists_are_dealt_again(spark):
    """Clusters of fingerprints a few bits apart, lists of four rows at most in a task: the same components."""
    rng = random.Random(7)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)}
    fps = sorted(fps, key=op._signed)
    df = spark.createDataFrame([(op._signed(f),) for f in fps], "fp bigint")
    roots = brute_components(fps)
    for rows in (4, op.LIST_ROWS):
        got = {r.node: r.root for r in op.components(op._links(df, 3, rows)).collect()}
        assert [got.get(op._signed(f), op._signed(f)) for f in fps] == [op._signed(fps[r]) for r in roots]
        assert len(set(got.values())) < len(got)
