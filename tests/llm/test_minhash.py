import random

import numpy as np
import pytest

from tablework.llm import minhash
from tablework.llm.minhash import circulant_signatures, near_duplicates


def sets_of(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(docs, k, percent=80):
    """{(doc_id, text): (set size, component)} by comparing all pairs."""
    sets = [sets_of(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[root(i)] = min(ids.get(root(i), d), d)
    return {(d, len(sets[i]), ids.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)}


def crowd(n, seed=5):
    """A text, copies of it with some words replaced, and other texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(900)}" for _ in range(80)]
    docs = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            words[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        docs.append((i + 10, " ".join(words)))
    docs += [(5000 + i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    docs += [(6000, None), (6001, ""), (6002, " \n"), (6003, "One"), (6004, "oNE"), (6005, "a b"), (6006, "A\tB"), (None, docs[0][1]), docs[3], docs[3]]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("listed", [30, 2])
@pytest.mark.parametrize("k", [2, 5])
def test_against_all_pairs(spark, monkeypatch, listed, k):
    monkeypatch.setattr(minhash, "LISTED", listed)
    monkeypatch.setattr(minhash, "CELL_ROWS", 16)
    docs = crowd(150)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, n string")
    rows = near_duplicates(df, shingle=k).collect()
    assert len(rows) == len(docs)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == brute(docs, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    groups = {r.component_id for r in rows if r.n_shingles}
    assert sum(r.chosen for r in rows if r.n_shingles) == len(groups)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    values = np.concatenate([common, a, common, b])
    first, second = circulant_signatures(values, np.array([0, 800, 1600]), 2048)
    assert abs((first == second).mean() - 0.6) < 0.05
