from pyspark.sql import functions as F

from tablework.functions import text as T

SAMPLES = [
    "Hello, World! it's 2nd &amp; 3rd --dashed-- (round) a",
    "W\xf6rld Été na\xefve Σίσυφος 中文 \U0001d54f\U0001d550\U0001d551\U0001d552\U0001d553\U0001d554",
    "&lt;a&#3; Reuter <tag attr='1'>inside</tag>\nline two <open\n close> REUTER &#3;",
    "non\xa0breaking space\x1cfield\x85next",
    "abcdefghijklmnopqrstuvwxyz abcdefghijklmnopqrstuvwxyza under_score",
    "...",
    "",
    "tiny",
]


def run(spark, column):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, text string")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


# What the tokenisers have to find in each sample.
LETTER_TOKENS = [
    ["hello", "world", "dashed", "round", "a"],
    ["wörld", "été", "naïve", "σίσυφος", "中文"],
    ["a", "reuter", "tag", "line", "two", "open", "close", "reuter"],
    ["non", "breaking", "space", "field", "next"],
    ["abcdefghijklmnopqrstuvwxyz"],
    [],
    [],
    ["tiny"],
]
STORY_TOKENS = [
    ["hello", "world", "it", "s", "2nd", "3rd", "dashed", "round", "a"],
    ["wörld", "été", "naïve", "σίσυφος", "中文", "\U0001d54f\U0001d550", "\U0001d552\U0001d553\U0001d554"],
    ["a", "inside", "line", "two", "open", "close"],
    ["non", "breaking", "space", "field", "next"],
    ["abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyza", "under_score"],
    [],
    [],
    ["tiny"],
]
# Runs of five characters of "tiny", "wörld été" and so on, by hand.
SHINGLES = {
    3: {
        "non b", "on br", "n bre", " brea", "break", "reaki", "eakin", "aking", "king ", "ing s", "ng sp", "g spa", " spac", "space",
        "pace ", "ace f", "ce fi", "e fie", " fiel", "field", "ield ", "eld n", "ld ne", "d nex", " next",
    },
    5: set(),
    7: set(),
}


def test_words(spark):
    got = run(spark, T.words("text"))
    assert got[0] == ["hello", "world", "it", "2nd", "amp", "3rd", "dashed", "round"]
    assert got[6] == []


def test_letter_tokens(spark):
    assert run(spark, T.letter_tokens("text")) == LETTER_TOKENS


def test_story_tokens(spark):
    assert run(spark, T.story_tokens("text")) == STORY_TOKENS


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "text string")
    row = df.select(T.words("text"), T.letter_tokens("text"), T.unescape("text")).first()
    assert list(row) == [None, None, None]


def test_shingles_step_by_whole_characters(spark):
    got = run(spark, T.shingles(T.letter_tokens("text"), 5))
    assert {i: set(got[i]) for i in SHINGLES} == SHINGLES
    assert {"wörld", "d été", "ve σί", "ος 中文"} <= set(got[1]) and len(got[1]) == 22
    assert len(got[4]) == 22
    assert all(len(s) == len(set(s)) for s in got)


def test_blocks_and_story_line(spark):
    df = spark.createDataFrame([("x<B>one\ntwo REUTER &#3;</B>y<B></B><B>open",)], "t string")
    row = df.select(T.blocks_between("t", "<B>", "</B>").alias("found")).first()
    assert row.found == ["one\ntwo REUTER &#3;", ""]
    line = df.select(T.story_line(F.lit("one\ntwo REUTER &#3;")).alias("s")).first()
    assert line.s == "one two "


def test_day_of(spark):
    df = spark.createDataFrame([("2015-11-08 12:20:42",)], "d string")
    assert df.select(T.day_of("d").alias("d")).first().d == "2015-11-08"
