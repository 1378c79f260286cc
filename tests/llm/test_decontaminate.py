import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablework.llm.decontaminate import contamination, is_contaminated


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window):
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            v = words(passage)
            n = min(window, len(v))
            for i in range(len(v) - n + 1) if v else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit |= set(range(j, j + n))
                        if item is not None:
                            found.add(str(item))
        out[d, text] = (len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("window,block", [(4, 100_000), (13, 7), (3, 1)])
def test_against_brute_force(spark, window, block):
    rng = random.Random(window)
    pool = ["the", "of", "a", "Bé", "x1", "zz", "cat", "Dog"]
    passage = lambda n: " ".join(rng.choice(pool) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [(i, passage(rng.randrange(1, 25))) for i in range(12)] + [(50, None), (51, " ?!"), (None, passage(6)), (52, "unseen"), (7, passage(8))]
    docs = [(i, passage(rng.randrange(60))) for i in range(60)]
    docs += [(100 + i, f"{passage(9)} {text} {passage(30)}") for i, (_, text) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "..."), (None, items[0][1]), docs[3], docs[3], (203, "the " * 3000)]
    df = spark.createDataFrame([(d, t, "i") for d, t in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    rows = contamination(df, bench, window, block).withColumn("contaminated", is_contaminated()).join(
        df.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).distinct().withColumnRenamed("doc_id", "d"),
        F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("d").isNull() | F.lit(True)), "inner",
    ).collect()
    want = brute(docs, items, window)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) == want[r.d, r.text]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in contamination(docs, none).collect()] == [(2, 0, [])]
    assert contamination(docs.limit(0), none).collect() == []


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    plan = contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(F.lit(""), 256)).first()[0]
