import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablework.llm.ppm import _Table, score_texts, text_words


def symbols(text, order):
    return [0] * order + [b + 1 for b in (text or "").encode().lower()] + [0]


class Trie:
    """Counts of all contexts, and the score of a text symbol by symbol with exclusion sets."""

    def __init__(self, texts, order):
        self.order, self.counts = order, defaultdict(Counter)
        for t in texts:
            s = symbols(t, order)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.counts[tuple(s[i - k : i])][s[i]] += 1

    def score(self, text):
        s, total = symbols(text, self.order), 0.0
        for i in range(self.order, len(s)):
            excluded, p = set(), 1.0
            for k in range(self.order, -1, -1):
                seen = self.counts.get(tuple(s[i - k : i]))
                if not seen:
                    continue
                rest = {c: n for c, n in seen.items() if c not in excluded}
                t = sum(rest.values())
                if s[i] in rest:
                    p *= (2 * rest[s[i]] - 1) / (2 * t)
                    break
                if rest:
                    p *= len(rest) / (2 * t)
                excluded |= set(seen)
            else:
                p /= 257 - len(excluded)
            total += math.log10(p)
        return total


def base(docs):
    counts = Counter()
    for _, text, learn in docs:
        if learn:
            counts.update((text or "").encode().lower().split() + ["end"])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, text, learn in docs:
        words = (text or "").encode().lower().split() + ["end"]
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out[d] = (not learn, len(words), sum(counts[w] > 0 for w in words), n, score)
    return out


@pytest.mark.parametrize("order,grams,words", [(3, 1 << 20, 1 << 17), (3, 20, 3), (5, 1, 1), (2, 0, 0)])
def test_against_a_trie(spark, order, grams, words):
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice(["the", "The", "cat", "ät", "on", "mat\n"]) for _ in range(rng.randrange(12))), i % 3 > 0) for i in range(60)]
    docs += [(100, None, True), (101, "", False), (102, "zebra QUIZ 中\x00", False), (103, "a" * 5000, True), (104, "\x0b ", None)]
    df = spark.createDataFrame([(d, t, x, 0.5) for d, t, x in docs], "doc_id long, text string, learn boolean, score double")
    rows = {r.doc_id: r for r in score_texts(df, order=order, hot_grams=grams, hot_words=words).collect()}
    trie, want = Trie([t for _, t, x in docs if x], order), base([(d, t, bool(x)) for d, t, x in docs])
    assert set(rows) == set(want)
    for d, t, _ in docs:
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[d][:4]
        assert r.base_score == pytest.approx(want[d][4], rel=1e-9)
        assert r.score == pytest.approx(trie.score(t), rel=1e-9)


def test_nothing_to_learn_and_repeated_rows(spark):
    schema = "doc_id long, text string, learn boolean"
    rows = score_texts(spark.createDataFrame([(1, "ab", False), (1, "ab", False), (None, "b", None)], schema)).collect()
    assert sorted(r.score for r in rows) == pytest.approx([3 * -math.log10(257)] * 2 + [2 * -math.log10(257)])
    assert score_texts(spark.createDataFrame([], schema)).collect() == []


def test_table_of_numbers():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 54, 5000))
    table = _Table(keys[::2], np.arange(len(keys[::2]), dtype=float))
    value, found = table.get(keys)
    assert found.tolist() == [i % 2 == 0 for i in range(len(keys))]
    assert (value[::2] == np.arange(len(keys[::2]))).all()


def test_words_of_texts():
    texts = ["", None, " A\tb  C ", "x\x0b\x0cy", "é É"]
    words, at = text_words(pa.array(texts).slice(1))
    found = [words.slice(a, b - a).cast(pa.string()).to_pylist() for a, b in zip(at[:-1], at[1:])]
    assert found == [[], ["a", "b", "c"], ["x", "y"], ["é É"]]
