import random
from collections import Counter
from itertools import combinations
from math import log

import pyarrow as pa
import pytest

from tablework.llm.language import BITS, PENALTY, _grams, fit_languages, identify, mixtures

SYLLABLES = {"en": ["the", "and", "ing", "ther", "wh"], "de": ["der", "sch", "ung", "ein", "ich"], "fr": ["eau", "éa", "que", "ion", "ça"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(text(rng, lang, 40), lang) for lang in SYLLABLES for _ in range(40)] + [(None, "en"), ("kein label", None), ("", "de")]
    return fit_languages(spark.createDataFrame(rows, "text string, lang string"))


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randrange(3, 60)), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    found = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert len(found) == len(rows)
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(rows)
    assert all(0 <= r.score <= r.known + 1e-9 <= 1 + 1e-6 for r in found)


def test_mixtures(spark, model):
    rng = random.Random(3)
    half = text(rng, "en", 300) + " " + text(rng, "fr", 100)
    row = identify(spark.createDataFrame([(half,)], "text string"), model).first()
    shares = {x.lang: x.share for x in row.languages}
    assert set(shares) == {"en", "fr"} and row.lang_pred == "en"
    size = len(half.encode())
    assert abs(shares["fr"] - len(half.encode()[half.encode().rfind(b" ", 0, size // 2) :]) / size) < 0.5
    assert 0.55 < shares["en"] < 0.9 and 0.1 < shares["fr"] < 0.45


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "12 !?\n"), (4, "汉字漢字" * 30), (5, "a"), (5, "a"), (None, "der ich"), (7, "the and " * 20000)]
    df = spark.createDataFrame([(d, t, "x", 9.0) for d, t in rows], "doc_id long, text string, letters string, score double")
    found = identify(df, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i in (1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].known, by_id[i].languages) == ("und", 0, 0, [])
    assert by_id[4].known < 0.2 and by_id[4].lang_pred in SYLLABLES
    assert by_id[7].lang_pred == "en" and by_id[7].known > 0.9
    assert by_id[7].letters == "x"
    assert identify(df.limit(0), model).collect() == []


def test_nothing_learned(spark):
    df = spark.createDataFrame([("some text",)], "text string")
    none = fit_languages(spark.createDataFrame([], "text string, lang string"))
    row = identify(df, none).first()
    assert (row.lang_pred, row.score, row.known) == ("und", 0, 0)


def expectation_maximisation(counts, model, some, rounds=300):
    """(shares, penalised log likelihood) of the languages ``some`` and the background, by plain loops."""
    like = {g: [float(model.likelihood[g, j]) for j in some] + [2.0**-BITS] for g in counts}
    total, share = sum(counts.values()), [1 / (len(some) + 1)] * (len(some) + 1)
    for _ in range(rounds):
        sums = [0.0] * len(share)
        for g, n in counts.items():
            parts = [s * x for s, x in zip(share, like[g])]
            for j, x in enumerate(parts):
                sums[j] += n * x / sum(parts)
        share = [x / total for x in sums]
    fit = sum(n * log(sum(s * x for s, x in zip(share, like[g]))) for g, n in counts.items())
    return share, fit - PENALTY * len(some) * log(total + 1) / 2


def test_sets_and_shares_against_all_sets(model):
    """Each set of the three languages is tried in full: the chosen one must be the best, with its shares."""
    rng = random.Random(8)
    texts = []
    for i in range(24):
        langs = rng.sample(list(SYLLABLES), 1 + i % 3)
        texts.append("  " + " ".join(text(rng, lang, rng.randrange(20, 60)) for lang in langs) + " zzxqj" * (i % 4) + "  ")
    found = mixtures(model, pa.array(texts))
    k, right = len(model.langs), 0
    for row, body in zip(found, texts):
        counts = Counter(_grams(pa.array([body]))[0].tolist())
        tried = {some: expectation_maximisation(counts, model, some) for n in range(1, k + 1) for some in combinations(range(k), n)}
        best = max(tried, key=lambda some: tried[some][1])
        mine = tuple(j for j in range(k) if row[j] > 0)
        assert tried[best][1] - tried[mine][1] <= 0.01 * abs(tried[best][1])
        right += mine == best
        for j, x in zip([*mine, k], tried[mine][0]):
            assert abs(row[j] - x) < 0.03, (row, tried[mine])
    assert right >= 22
