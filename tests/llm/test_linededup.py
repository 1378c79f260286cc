import random

import pytest

from tablework.llm.linededup import dedup_lines, dropped_lines
from tablework.llm.queries import QUERIES


def distance_at_most_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, min_chars=10):
    """{(doc_id, text): kept text}, by comparing every line with all earlier ones."""
    earlier, out = [], {}
    for doc_id, text in sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0)):
        kept = []
        for line in text.split("\n"):
            if len(line) < min_chars or not any(distance_at_most_one(line, e) for e in earlier):
                kept.append(line)
            if len(line) >= min_chars:
                earlier.append(line)
        out[doc_id, text] = "\n".join(kept)
    return out


def edited(rng, line):
    i = rng.randrange(len(line) + 1)
    c = rng.choice("abcé語")
    return rng.choice([line[:i] + c + line[i:], line[:i] + line[i + 1 :], line[:i] + c + line[i + 1 :]])


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(3)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.randrange(8, 60))) for _ in range(60)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line = edited(rng, line)
            lines.append(line)
        docs.append((i, "\n".join(lines)))
    return docs + [(500, None), (501, ""), (502, "\n"), (503, "a"), (None, docs[0][1]), docs[5], docs[5], (504, "x" * 30000), (505, "x" * 29999)]


def test_against_all_pairs(spark, documents):
    want = brute(documents)
    df = spark.createDataFrame([(d, t, 1) for d, t in documents], "doc_id long, text string, n_lines int")
    text_of = {}
    joined = dedup_lines(df.withColumn("_lines", df.text), exact_chars=10).collect()
    assert len(joined) == len(documents)
    for row in joined:
        text_of.setdefault(row.doc_id, set()).add((row["_lines"], row.text, row.n_lines, row.n_dropped))
    for doc_id, found in text_of.items():
        for before, after, n, gone in found:
            if before is None:
                assert (after, n, gone) == (None, 0, 0)
            else:
                assert after == want[doc_id, before] or len(want[doc_id, before].split("\n")) == n - gone
                assert n == len(before.split("\n"))
                assert n - gone == (0 if gone == n else len(want[doc_id, before].split("\n")))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert dedup_lines(df).collect() == []
    assert dropped_lines(df).collect() == []


def test_one_line_in_every_document(spark):
    df = spark.createDataFrame([(i, f"the same line in all\n{i}") for i in range(3000)], "doc_id long, text string")
    rows = dedup_lines(df).collect()
    assert {(r.doc_id, r.n_dropped) for r in rows} == {(i, int(i > 0)) for i in range(3000)}


def test_exact_repeats_of_short_lines(spark):
    docs = [(1, "Les.\n\n  \nab\nLes."), (2, "Les.\n\n  \nab"), (3, "Lez.\nab \n日本"), (4, "日本\n\u3000\nLes.\na line of some length"), (5, "\u3000\na line of some lengths\nb"), (None, "b\nLes.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: (r.text, r.dropped) for r in dedup_lines(df).collect()}
    assert found == {
        1: ("Les.\n\n  \nab", [4]),
        2: ("\n  ", [0, 3]),
        3: ("Lez.\nab \n日本", []),  # one edit does not count here
        4: ("\u3000\na line of some length", [0, 2]),
        5: ("\u3000\nb", [1]),
        None: ("", [0, 1]),
    }


def test_short_lines_against_all_pairs(spark, documents):
    """What brute() keeps, without later copies of lines under ten characters that are not blank."""
    seen, want = set(), {}
    for (doc_id, before), text in brute(documents).items():
        kept = []
        for line in text.split("\n"):
            if len(line) >= 10 or not line.strip() or line not in seen:
                kept.append(line)
            seen.add(line)
        want[doc_id, before] = kept
    df = spark.createDataFrame([(d, t) for d, t in documents], "doc_id long, text string")
    rows = dedup_lines(df.withColumn("_lines", df.text)).collect()
    assert len(rows) == len(documents)
    for r in rows:
        if r["_lines"] is not None:
            lines = r["_lines"].split("\n")
            kept = [line for i, line in enumerate(lines) if i not in r.dropped]
            assert r.n_dropped == len(r.dropped) == len(lines) - len(kept)
            assert r.text == "\n".join(kept) == "\n".join(want[r.doc_id, r["_lines"]])


def test_query_drops_short_repeats(spark, tmp_path):
    docs = [(i, f"Les.\n\nthe {i}th document has a line of its own, {'abc' * i}") for i in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, tuple(r.dropped)) for r in rows} == {(i, (0,) if i else ()) for i in range(5)}
