"""The pipeline's stages against brute force on small tables, each on its own input."""

import random
import sys
from zlib import crc32

import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tablework.llm.pieces import MODEL_FILE
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_language import SYLLABLES, text
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, top = random.Random(4), tmp_path_factory.mktemp("tables")
    items = [(i, text(rng, "en", 30)) for i in range(4)]
    docs = []
    for i in range(160):
        lang = rng.choice(list(SYLLABLES))
        docs.append([i, "\n".join(text(rng, lang, rng.randrange(12, 30)) for _ in range(rng.randrange(1, 5))), lang])
    for i in range(160, 190):  # near copies, one word of each line replaced
        lines = [line.split(" ") for line in docs[rng.randrange(40)][1].split("\n")]
        for words in lines:
            words[rng.randrange(len(words))] = "ein"
        docs.append([i, "\n".join(" ".join(w) for w in lines), "de"])
    for i in range(190, 200):
        docs.append([i, docs[i - 100][1] + "\n" + items[i % 4][1], "en"])
    docs += [[200, docs[5][1], "en"], [201, None, "en"], [202, "", None], [203, "12345 67", "en"], [204, "汉字漢字" * 40, None]]
    docs += [[205, docs[7][1] + "\n" + docs[8][1], "en"], docs[9], docs[9], [206, "  two  blanks ▁ 日本 the and ing", "en"], [None, docs[11][1] + "\nther wh the and ingand thewh", "en"]]
    rows = [(d, t, lang, "s", len(t or "")) for d, t, lang in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return str(top)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontaminate", "pieces"]

    def apply(name, docs):
        out = steps[name](spark, docs, folder)
        if name != "pieces":
            assert out.dtypes == docs.dtypes
        return spark.createDataFrame(out.collect(), out.schema)

    kept = apply("language", docs)
    assert sorted(map(str, pairs(kept))) == sorted(str(p) for p in pairs(docs) if p[0] not in (201, 202, 203, 204))

    rest = brute_lines(pairs(kept))
    want = sorted(str((d, rest[d, t])) for d, t in pairs(kept) if rest[d, t])
    lines = apply("lines", kept)
    assert sorted(map(str, pairs(lines))) == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    groups = brute_groups(pairs(lines), 5)
    near = apply("near_duplicates", lines)
    assert sorted(str(r.doc_id) for r in near.collect()) == sorted({str(c) for _, _, c in groups})

    hits = brute_hits(pairs(near), items, 13)
    clean = apply("decontaminate", near)
    assert sorted(map(str, pairs(clean))) == sorted(str(p) for p in pairs(near) if not hits[p][4])
    assert len(pairs(clean)) < len(pairs(near))

    last = apply("pieces", clean).collect()
    sp = SentencePieceProcessor(model_file=MODEL_FILE)
    texts = dict(pairs(clean))
    assert sorted(str(r.doc_id) for r in last) == sorted(map(str, texts))
    for r in last:
        assert r.round_trip and r.n_pieces == len(r.pieces)
        if "▁" not in texts[r.doc_id]:
            assert sp.decode(r.pieces) == texts[r.doc_id]

    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((str(r.doc_id), r.pieces) for r in found) == sorted((str(r.doc_id), r.pieces) for r in last)


def test_copies_with_short_or_blank_lines_go(spark):
    story = "the first line of a story\nLes.\n\nthe last line of a story"
    texts = [(1, story), (2, story), (3, "Les.\n \u3000"), (4, "Les.\nMore."), (5, None), (None, story)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts], SCHEMA)
    found = corpus_pipeline.lines(spark, docs, "").collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in found} == {(1, story, len(story)), (4, "More.", 5), (5, None, 0)}


def test_languages_are_learned_from_all_labelled_rows(spark):
    rng = random.Random(8)
    held_out = [i for i in range(400) if crc32(str(i).encode()) % 5 == 0][:30]
    rows = [(i, text(rng, "de", 30), "de") for i in held_out] + [(None, text(rng, "fr", 30), "fr") for _ in range(30)]
    rows += [(i, text(rng, "en", 30), "en") for i in range(400, 430)]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in rows], SCHEMA)
    found = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted(map(str, found)) == sorted(map(str, docs.collect()))


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_named_by_the_entry():
    assert "corpus_pipeline" in sys.modules
