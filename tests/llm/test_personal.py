import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablework.llm import personal
from tablework.llm.personal import KINDS, LABELERS, as_text, candidates, find_personal, reliabilities, votes

# The base rules as the contract has them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    None, "", "nothing here", "a@b.c_d@e.f@g.h", "ü.x@y.org é@z.fr", "😀 me@x.com 😀 1.2.3.4.5.6.7.8",
    "1.2.3.256 and 255.255.255.255 and 0001.02.003.4", "4111 1111 1111 1111 x 4111-1111-1111-1112",
    "4111 1111 1111 1111 2024 2025", "5 - 4111111111111111 -6", "1 4111111111111111", "+1 (017) 555-7713 +49 30 1234567 +1 2",
    "+1 (826) 555-4081 190.137.223.204", "call (826) 555-4081 or bob (at) site [dot] org", "++4 4 4-(((", "+12..34(56)78 +",
    "a@b a@b. a@.b @x.y -@-.-", "me@mail.example.com" * 3, "1234567890123456 " * 3, "fe80:0:0:0:1:2:3:4 10[.]0[.]0[.]1",
]


def test_base_spans_are_those_of_the_plain_rules(spark):
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, start int, spans string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in find_personal(docs).collect()}
    assert found == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_random_texts(spark):
    import random

    rng = random.Random(3)
    parts = ["a", "@", ".", "b", "1", "2", " ", "-", "+", "(", ")", "_", "é", "12", "255", "4111111111111111", "😀", "x.y"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_personal(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == plain(texts[r.doc_id]), texts[r.doc_id]
        assert [(KINDS.index(s.kind), s.start, s.end) for s in r.spans] == sorted((KINDS.index(s.kind), s.start, s.end) for s in r.spans)


def test_very_long_texts_take_linear_time(spark):
    n = 300_000
    texts = ["a" * n, "1" * n, "1 " * n, "a@" * n, "1." * n, "+1" + "(" * n, "a@b" + ".c" * n, "+1 (017) 555-7713 " * 20_000, "(at) " * n]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base] for r in find_personal(docs).collect()}
    for i in (0, 1, 2, 3, 5, 6, 8):
        assert found[i] == ([("email", 0, 3 + 2 * n)] if i == 6 else [])
    assert len([s for s in found[4] if s[0] == "ip"]) == n // 4
    assert len(found[7]) == 20_000


def em(rows, rounds=personal.ROUNDS):
    """Plain expectation-maximisation over the spans themselves, one by one."""
    truth = [0.5 + 0.4 * r["check"] for r in rows]
    before = None
    for _ in range(rounds):
        odds, prior = {}, {}
        for k in range(len(KINDS)):
            mine = [(r, p) for r, p in zip(rows, truth) if r["kind"] == k]
            for name in LABELERS:
                rate = {}
                for side in (1, 0):
                    tally = {-1: (4, 1)[side], 0: 2, 1: (1, 4)[side]}
                    for r, p in mine:
                        tally[r[name]] += p if side else 1 - p
                    rate[side] = {v: n / sum(tally.values()) for v, n in tally.items()}
                for v in (-1, 0, 1):
                    odds[k, name, v] = math.log(rate[1][v] / rate[0][v])
            good = sum(p for _, p in mine)
            prior[k] = math.log((good + 1) / (len(mine) - good + 1))
        truth = [1 / (1 + math.exp(-prior[r["kind"]] - sum(odds[r["kind"], n, r[n]] for n in LABELERS))) for r in rows]
        if before and max(abs(before[x] - odds[x]) for x in odds) < personal.SETTLED:
            break
        before = odds
    return truth


def mixed(spark):
    texts = [f"card {4000000000000000 + 37 * i} and +1 (017) 555-{1000 + i} or id {9000000000000000 + 91 * i} end" for i in range(60)]
    texts += [f"write to me{i}@x.com or me{i} (at) y (dot) org from 8.8.{i}.1, version 10[.]0[.]0[.]{i}" for i in range(40)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_reliabilities_equal_a_plain_loop(spark):
    voted = personal.stage(votes(candidates(mixed(spark))[1]), "votes")
    rows = voted.withColumn("p", reliabilities(voted)).collect()
    want = em([r.asDict() for r in rows])
    assert max(abs(r.p - w) for r, w in zip(rows, want)) < 1e-9
    assert len({round(r.p, 3) for r in rows}) > 4


def test_added_spans(spark):
    rows = find_personal(mixed(spark)).collect()
    added = Counter(s.kind for r in rows for s in r.spans if not s.base)
    assert added["email"] == 40
    for r in rows:
        assert all(s.base or s.score >= 0.9 for s in r.spans)
    # numbers that fail the check are left alone
    assert not any(s.kind == "card" and not s.base for r in rows for s in r.spans)


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert find_personal(spark.createDataFrame([], schema)).collect() == []
    docs = spark.createDataFrame([(None, "a@b.c"), (None, None), (1, "a@b.c"), (1, "a@b.c"), (2, "")], schema)
    got = Counter((r.doc_id, r.t) for r in find_personal(docs).select("doc_id", as_text(F.col("spans")).alias("t")).collect())
    assert got == {(None, "email:0:5"): 1, (None, ""): 1, (1, "email:0:5"): 2, (2, ""): 1}


@pytest.mark.parametrize("word", ["Python", "Arrow", "Pandas"])
def test_no_python_in_the_plan(spark, word):
    plan = find_personal(mixed(spark))._jdf.queryExecution().executedPlan().toString()
    assert word not in plan
