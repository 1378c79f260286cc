import random

import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from tablework.llm.pieces import MODEL_FILE, decode_pieces, encode_texts, read_model, tokenize

TEXTS = [
    "", " ", "  two  blanks ", "The quick brown fox", "a\nb\tc\r\n", "Straße übergrößen ÀÉ", "日本語のテキスト と 漢字", "🙂 smile🙂🙂",
    "▁ own ▁▁ sign▁", "x" * 700, "abc" * 200 + " " + "é" * 50, "\x00 nul", "<0x41> <s> </s> <unk>", "The quick brown fox",
]


@pytest.fixture(scope="module")
def model():
    return read_model()


def brute(text):
    """The best segmentation of the whole text, one character at a time."""
    sp = SentencePieceProcessor(model_file=MODEL_FILE)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    table = {sp.id_to_piece(i): (sp.get_score(i), i) for i in plain}
    worst, longest = min(s for s, _ in table.values()) - 10, max(map(len, table))
    if not text:
        return []
    text = "▁" + "".join({" ": "▁", "▁": ""}.get(c, c) for c in text)
    best = [(0.0, None, None)]
    for end in range(1, len(text) + 1):
        top = (float("-inf"), None, None)
        for start in range(max(0, end - longest), end):
            if text[start:end] in table:
                score, i = table[text[start:end]]
                top = max(top, (best[start][0] + score, start, i), key=lambda x: x[0])
        if best[end - 1][0] + worst > top[0]:
            top = (best[end - 1][0] + worst, end - 1, None)
        best.append(top)
    out, end = [], len(text)
    while end:
        _, start, i = best[end]
        if i is None:
            raw = text[start:end].replace("", "▁").encode()
            out += [sp.piece_to_id(f"<0x{b:02X}>") for b in reversed(raw)]
        else:
            out.append(i)
        end = start
    return out[::-1]


def lists(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_against_brute_force(model):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abeths tiüß語") for _ in range(rng.randrange(60))) for _ in range(150)]
    ids, offsets = encode_texts(model, pa.array(texts))
    assert lists(ids, offsets) == [brute(t) for t in texts]
    assert decode_pieces(model, ids, offsets).to_pylist() == texts


def test_table(spark, model):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(99, None, None), (None, "a b", None), (3, TEXTS[3], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    out = tokenize(df, model).collect()
    assert len(out) == len(rows)
    for row in out:
        assert row.decoded == row.text
        assert row.n_pieces == len(row.pieces or [])
    assert [r for r in out if r.text is None][0].pieces is None
    assert tokenize(df.limit(0), model).collect() == []


def test_long_unbroken_words(model):
    import time

    draw = random.Random(8)
    word = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/", k=200_000))
    start = time.time()
    ids, offsets = encode_texts(model, pa.array([word, word[:3000]]))
    assert time.time() - start < 10
    assert decode_pieces(model, ids, offsets).to_pylist() == [word, word[:3000]]
    assert ids[offsets[1] :].tolist() == brute(word[:3000])
