from itertools import permutations

import numpy as np

from tablework.llm.survival import FILTERS, SUBSETS, WORDS, audit, positional_popcount, survivors


def test_words():
    for failed in range(SUBSETS):
        for subset in range(SUBSETS):
            assert bool(int(WORDS[failed]) >> subset & 1) == (failed & subset == 0)


def test_popcount_equals_a_plain_count():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 100, 1000):
        words = rng.integers(0, 1 << 32, n).astype(np.uint32)
        counts = rng.integers(0, 5000, n)
        want = [sum(int(c) for w, c in zip(words, counts) if int(w) >> b & 1) for b in range(32)]
        assert positional_popcount(words, counts).tolist() == want


def fails(i, rows):
    doc_id, text, _ = rows[i]
    text = text or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows):
        out.add("E")
    return out


def brute(rows, labels):
    failed = [fails(i, rows) for i in range(len(rows))]
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        share = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in failed[i]]
                left = [i for i in left if f not in failed[i]]
                share[f] += len(gone)
                lost = [sum(any(d == rows[i][0] and row[k] == 1 for d, *row in labels) for i in gone if rows[i][0] is not None) for k in (0, 1)]
                total = sum(f in failed[i] for i in mine)
                out[part, "".join(order), step] = [len(left), len(gone), total - len(gone), sum(failed[i] == {f} for i in mine), *lost]
        for order in permutations(FILTERS):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(share[f])
    return out


def check(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, s, 1, 0) for d, t, s in rows], "doc_id long, text string, source string, n long, failed int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in audit(survivors(docs, marks)).collect()}
    assert got == brute(rows, labels)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words[: int(rng.choice([10, 80]))], int(rng.choice([20, 49, 50, 90]))))
        text += rng.choice(["", " ABCDEFGHIJKLMNOPQRSTUVWXYZ", " #", " é\t\n"])
        rows.append((i, text, str(rng.choice(["a", "b"]))))
    rows += [(1000 + i, rows[i % 7][1], "c") for i in range(200)]
    rows += [(2000, None, None), (2001, "", ""), (2002, None, "a"), (None, "lost", "a"), (None, "lost", "a"), (5, rows[5][1], rows[5][2])]
    rows += [(3000, "X y " * 20_000, "a"), (1, rows[0][1], "z"), (0, rows[0][1], "z")]
    labels = [(i, int(rng.integers(2)), int(rng.integers(2))) for i in range(0, 1100, 2)] + [(4, 1, None), (4, 0, 1), (None, 1, 1), (9, None, None)]
    check(spark, rows, labels)


def test_small_tables(spark):
    check(spark, [], [])
    check(spark, [(1, None, None)], [(1, 1, 1), (1, 1, 1)])
    check(spark, [(None, None, "a"), (2, "same", "a"), (1, "same", "b")], [])
