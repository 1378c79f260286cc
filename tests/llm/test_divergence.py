import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablework.llm.divergence import divergences, joint_table


def test_joint_table_is_the_product_of_one_hot_matrices():
    rng = np.random.default_rng(1)
    for n, n_a, n_b in ((500, 4, 6), (20, 40, 30), (0, 1, 1)):
        a, b = rng.integers(0, n_a, n), rng.integers(0, n_b, n)
        i, j, count = joint_table(a, b, n_a, n_b)
        table = np.zeros((n_a, n_b), dtype=int)
        table[i, j] = count
        assert (table == np.eye(n_a, dtype=int)[a].T @ np.eye(n_b, dtype=int)[b]).all()


def brute(rows, least=10, best=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        everything = Counter()
        for s in sources:
            everything.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) * (p - q) // (p + q)

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(everything)
        for s in sources:
            pairs = [(h, sum(f(p[s][t], p[h][t]) for t in kept)) for h in sources if h != s]
            more = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", more, best)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(found[:limit], 1)]
    return sorted(out)


def run(spark, rows, **blocks):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, p int")
    return sorted(tuple(r) for r in divergences(docs, **blocks).collect())


@pytest.mark.parametrize("terms, sources", [(4096, 64), (16, 3)])
def test_against_brute_force(spark, terms, sources):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "abcdeé" for b in "xyzÜ"] + ["Same", "same", "SAME"]
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(400):
        n = int(rng.choice([1, 5, 60]))
        text = " ".join(rng.choice(words, n, p=weights / weights.sum()))
        rows.append((text, str(rng.choice(["l1", "l2"])), f"s{rng.integers(8)}"))
    rows += [("ax by " * 30_000, "l1", "hot"), (None, None, None), ("", "l1", "nothing"), ("1 2 3 ax9by", "l1", None), ("only once", "l3", "a"), ("", "l3", "b")]
    rows += [("ax", "l1", "hot")] * 200
    assert run(spark, rows, block_terms=terms, block_sources=sources) == brute(rows)


def test_small_tables(spark):
    assert run(spark, []) == []
    for rows in ([(None, None, None)], [("a", "l", "s"), ("a", "l", "t")], [("a b", "l", "s")] * 10 + [("b", "l", "t")] * 10):
        assert run(spark, rows) == brute(rows)
