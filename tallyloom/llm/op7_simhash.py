"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in at most ``max_bits`` bits differ in
at most that many bytes, so they share at least ``8 - max_bits`` positional bytes: the guaranteed minimum. Posting
lists of single bytes would each hold 1/256 of all rows, so the index holds intersections of posting lists: keys of
four positional bytes, chosen so that every set of five positions contains at least one of the fourteen sets. Within a
posting list the shared bytes of each pair are tallied, pairs that reach the minimum are retained, and their distance
is verified.

Only distinct fingerprints enter the index. A list is resolved inside one task up to ``list_rows`` members: numpy
compares a frontier with the members not yet reached and only a spanning forest leaves the task, so a group of copies
never becomes all its pairs. A longer list is never held: it is dealt again by keys that fix further bits (the free
bits are cut into ``max_bits + 1`` parts, one of which must be equal), until at most 14 bits are free and a list cannot
have more than 16,384 members. This is exact for any input.

Defined results: a null or blank text has fingerprint zero and links like any other; a repeated row is returned as often
as it occurs; an id that is null never names a component (the component id is null if all its ids are); further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.graph import components
from tallyloom.operators.staging import stage

BYTES = 8
SEED = 42
LIST_ROWS = 16_384
FREE_BITS = 14
BLOCK = 1 << 16


def shingle_hashes(raw: bytes | None, words: int) -> np.ndarray:
    """Hashes of the word shingles of ``raw`` (bytes, A-Z lower-cased), in order; none for a blank text."""
    parts = raw.lower().split() if raw else []
    if not parts:
        return np.empty(0, np.uint64)
    text = b" ".join(parts)
    ends = [e - 1 for e in accumulate(len(p) + 1 for p in parts)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    if len(parts) < words:
        spans = [(0, len(text))]
    else:
        spans = zip(starts, ends[words - 1:])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[s:e], SEED) for s, e in spans), np.uint64)


def fingerprint(raw: bytes | None, words: int) -> int:
    """SimHash of the word shingles of ``raw``, as an unsigned integer."""
    hashes = shingle_hashes(raw, words)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at:at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the fingerprint's 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("raw"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), words) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(sketch, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def index_masks(max_bits: int) -> list[int]:
    """Bit masks of the positional-byte sets that serve as index keys."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be 0 to 7")
    if max_bits <= 3:  # two of four byte pairs, or one byte of each pair with an even number of second bytes
        pairs = [(2 * i, 2 * i + 1) for i in range(4)]
        sets = [x + y for x, y in combinations(pairs, 2)]
        sets += [tuple(p[i >> k & 1] for k, p in enumerate(pairs)) for i in range(16) if i.bit_count() % 2 == 0]
    else:
        sets = list(combinations(range(BYTES), BYTES - max_bits))
    return [sum(0xFF << 8 * i for i in s) for s in sets]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """``mask`` with one of ``max_bits + 1`` parts of its free bits added; whole bytes while they suffice."""
    free = [i for i in range(64) if not mask >> i & 1]
    parts = np.array_split(free, max_bits + 1)
    return [mask | sum(1 << int(i) for i in part) for part in parts]


def _spanning(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (root, member) that connect what ``max_bits`` connects among distinct ``fps``."""
    left, found = fps, []
    while len(left) > 1:
        root, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for one in front:
                rest = np.flatnonzero(~hit)
                differ = left[rest] ^ one
                shared = BYTES - np.count_nonzero(differ.view(np.uint8).reshape(-1, BYTES), axis=1)
                retained = rest[shared >= BYTES - max_bits]
                hit[retained[np.bitwise_count(left[retained] ^ one) <= max_bits]] = True
            front, left = left[hit], left[~hit]
            found += [(root, x) for x in front]
    return found


def _links(fps: DataFrame, max_bits: int, list_rows: int) -> DataFrame:
    """Links ``(a, b)`` among the distinct fingerprints ``fps(fp)`` that join the same components as all links."""
    masks, level, found = index_masks(max_bits), 0, None
    rows = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                                          for i, m in enumerate(masks)])).alias("k"), "fp").select("k.t", "k.key", "fp")
    while True:
        last = 64 - min(m.bit_count() for m in masks) <= FREE_BITS
        out = stage(rows.repartition("t", "key").sortWithinPartitions("t", "key")
                    .mapInArrow(_resolver(max_bits, None if last else list_rows), "t int, a bigint, b bigint"), "postings")
        links = out.where("t < 0").select("a", "b")
        found = links if found is None else found.union(links)
        long_lists = out.where("t >= 0")
        if last or long_lists.isEmpty():
            return found
        finer = [finer_masks(m, max_bits) for m in masks]
        n = max_bits + 1
        table = F.array(*[F.array(*[F.lit(_signed(x)) for x in f]) for f in finer])
        rows = (long_lists.select("t", F.col("a").alias("fp"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
                .select((F.col("t") * n + F.col("part")).alias("t"), F.col("fp").bitwiseAND(table[F.col("t")][F.col("part")]).alias("key"), "fp")
                .distinct())
        masks, level = [x for f in finer for x in f], level + 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _resolver(max_bits: int, list_rows: int | None):
    """Resolve posting lists that arrive sorted; rows of lists longer than ``list_rows`` pass through with ``t >= 0``."""
    def emit(t, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["t", "a", "b"])

    def closed(lists: list[np.ndarray]) -> pa.RecordBatch | None:
        pairs = [(int(x), int(y)) for fps in lists for x, y in _spanning(fps, max_bits)]
        if not pairs:
            return None
        a, b = np.array(pairs, np.uint64).view(np.int64).T
        return emit(np.full(len(a), -1), a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, key, fp = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        long_list = None
        for batch in batches:
            t = np.concatenate([t, batch.column(0).to_numpy().astype(np.int64)])
            key = np.concatenate([key, batch.column(1).to_numpy()])
            fp = np.concatenate([fp, batch.column(2).to_numpy().view(np.uint64)])
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            edges = np.concatenate([[0], cuts])
            if long_list is not None and len(t) and (t[0], key[0]) == long_list:
                end = cuts[0] if len(cuts) else len(t)
                yield emit(t[:end], fp[:end].view(np.int64), fp[:end].view(np.int64))
                if not len(cuts):
                    t, key, fp = t[:0], key[:0], fp[:0]
                    continue
                edges = cuts
            ends = np.append(edges[1:], len(t))
            size = ends - edges
            done, ready = len(edges) - 1, []
            for i in np.flatnonzero(size[:done] > 1):
                part = slice(edges[i], ends[i])
                if list_rows is not None and size[i] > list_rows:
                    yield emit(t[part], fp[part].view(np.int64), fp[part].view(np.int64))
                else:
                    ready.append(fp[part])
            if (out := closed(ready)) is not None:
                yield out
            rest = slice(edges[-1], None)
            t, key, fp = t[rest], key[rest], fp[rest]
            long_list = None
            if list_rows is not None and len(t) > list_rows:
                long_list = (t[0], key[0])
                yield emit(t, fp.view(np.int64), fp.view(np.int64))
                t, key, fp = t[:0], key[:0], fp[:0]
        if len(fp) > 1 and (out := closed([fp])) is not None:
            yield out

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3,
                    list_rows: int = LIST_ROWS) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` and ``component_id``, the smallest id reachable by links."""
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    roots = components(_links(classes.select("fp"), max_bits, list_rows)).withColumnRenamed("node", "fp")
    linked = stage(roots.join(classes, "fp"), "linked")
    firsts = linked.groupBy("root").agg(F.min("first").alias("reached"))
    named = (classes.join(linked.join(firsts, "root").select("fp", "reached"), "fp", "left")
             .select("fp", F.coalesce("reached", "first").alias("component_id")))
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: fingerprint and component of every document, by the contract's three-word shingles and three bits."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
