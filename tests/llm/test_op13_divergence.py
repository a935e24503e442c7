import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tallyloom.llm import op13_divergence as op
from tests.compare import same_rows
from tests.llm.tables import awkward_documents, empty_documents, write

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, rules):
    """All rows of the audit, term by term, for ``(lang, source, text)``."""
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= rules.least_documents]
        sources = [s for l, s in groups if l == lang]

        def shares(n):
            below = sum(n[t] for t in kept) + rules.smoothing * len(kept)
            return {t: 1 + rules.scale * (n[t] + rules.smoothing) // below for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        each = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(other, sum(abs(each[s][t] - each[other][t]) for t in kept)) for other in sources if other != s]
            terms = [(t, each[s][t] - whole[t]) for t in kept if counts[lang, s][t] and each[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, rules.terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_query(spark, sf_dir, duck):
    assert same_rows(op.query(spark, sf_dir), duck, op.SQL) > 0


def test_small_parts_give_the_same_rows(spark):
    """Many parts, slices and blocks, and merges over several rounds; few documents are enough for a term."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "aébßcz漢" for b in ("x", "y", "Yq", "é", "zz", "w", "k", "j")]
    rows = []
    for i in range(300):
        source = rng.choice(["hot"] * 8 + [f"s{j}" for j in range(9)] + [None])
        text = " ".join(rng.choices(words, weights=[1 + (hash_of(w, source) % 40) ** 2 for w in words], k=rng.randint(0, 60)))
        rows.append((i, rng.choice(["en", "en", "de", None]), source, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string")
    rules = op.Audit(least_documents=3, terms=4)
    want = brute([r[1:] for r in rows], rules)
    assert rows_of(op.audit(docs, rules)) == want
    assert rows_of(op.audit(docs, rules, slice_terms=9, block=3, part_rows=6, merged_rows=20)) == want
    assert {r[2] for r in want} == {"pair", "term"}


def hash_of(word, source):
    return sum(word.encode()) * 31 + sum((source or "").encode()) * 7


def test_awkward_and_empty(spark, tmp_path):
    docs = awkward_documents(spark)
    rules = op.Audit(least_documents=1, terms=3)
    assert rows_of(op.audit(docs, rules)) == brute([(r.lang, r.source, r.text) for r in docs.collect()], rules)
    none = rows_of(op.query(spark, write(docs, tmp_path)))  # nothing occurs in 30 documents
    assert {r[2] for r in none} == {"pair"} and {r[4] for r in none} == {0} and none == brute([(r.lang, r.source, r.text) for r in docs.collect()], op.Audit())
    empty = op.audit(empty_documents(spark))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and empty.count() == 0
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        assert same_rows(op.query(spark, str(tmp_path)), con, op.SQL) == len(none)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_skyband_keeps_what_can_lead(k):
    rng = np.random.default_rng(k)
    n, lang_n = rng.integers(0, 12, 700), rng.integers(0, 15, 700)
    names = np.array([f"t{x:04d}" for x in rng.permutation(700)], object)
    over = (n[None, :] >= n[:, None]) & (lang_n[None, :] <= lang_n[:, None]) & (names[None, :] < names[:, None])
    want = set(np.flatnonzero(over.sum(axis=1) < k))
    assert set(op.skyband(n, lang_n, names, k, chunk=64)) == want
    for a, b in ((1.0, 1.0), (7.0, 0.2), (0.1, 9.0), (1.0, 0.0)):
        order = sorted(range(700), key=lambda i: (-(a * n[i] - b * lang_n[i]), names[i]))
        assert set(order[:k]) <= want


def test_flushes_add_up(spark):
    docs = spark.createDataFrame([(f"{c} b", "en", "s") for c in "aab"] * 3, "text string, lang string, source string").coalesce(1)
    got = {r.term: (r.n, r.docs) for r in op.term_counts(docs, flush_at=2).collect()}
    assert got == {None: (0, 0), "a": (6, 6), "b": (12, 9)}
