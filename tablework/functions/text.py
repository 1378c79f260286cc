"""Text column expressions: tokenisers, record cutting, shingles."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Punctuation cut from both ends of a token, the word and the tag
# pattern taken out of a story, and the end-of-story mark.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TOKEN_EDGES = " –…" + PUNCTUATION
STORY_EDGES = "." + TOKEN_EDGES
STORY_WORD = "reuter"
STORY_TAG = "<[^\\n]*?>"
STORY_END = "REUTER &#3;"

# Python's idea of white space and word characters, as Java patterns.
SPACE = "\\s\\x0B\\x1C-\\x1F\\x85\\p{Z}"
WORD = "[\\p{L}\\p{N}_]+"


@F.pandas_udf(StringType())
def _decode_entities(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape(column: str) -> Column:
    """Decode HTML entities. Only texts with an ampersand are sent to Python."""
    text = F.col(column)
    return F.coalesce(_decode_entities(F.when(F.contains(text, F.lit("&")), text)), text)


def words(column: str | Column, min_length: int = 2) -> Column:
    """Lower-case words between non-word characters (ASCII), at least ``min_length`` long."""
    return F.regexp_extract_all(F.lower(column), F.lit(f"\\w{{{min_length},}}"), 0)


def letter_tokens(column: str) -> Column:
    """White-space tokens in lower case, edges stripped, kept if 1 to 26 letters.

    One pattern does it in one pass over the text: between white space, edge
    characters, letters, edge characters.
    """
    edges = "[" + re.escape(TOKEN_EDGES.replace(" ", "")) + "]*+"
    token = f"(?<![^{SPACE}]){edges}(\\p{{L}}{{1,26}}+){edges}(?![^{SPACE}])"
    return F.regexp_extract_all(F.lower(unescape(column)), F.lit(token), 1)


def story_tokens(column: str) -> Column:
    """Word-character runs of a story without its agency word and tags."""
    text = F.btrim(F.lower(unescape(column)), F.lit(STORY_EDGES))
    text = F.regexp_replace(F.replace(text, F.lit(STORY_WORD), F.lit("")), STORY_TAG, "")
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def day_of(column: str) -> Column:
    """The date part of a timestamp kept as text: its first ten characters."""
    return F.substring(F.col(column).cast("string"), 1, 10)


def blocks_between(column: str, opening: str, closing: str) -> Column:
    """All texts between two markers, in order."""
    pattern = f"(?s){re.escape(opening)}(.*?){re.escape(closing)}"
    return F.regexp_extract_all(column, F.lit(pattern), 1)


def story_line(column: str) -> Column:
    """A story on one line, without its end mark."""
    return F.replace(F.replace(column, F.lit("\n"), F.lit(" ")), F.lit(STORY_END), F.lit(""))


def shingles(tokens: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` characters of the tokens joined by one space.

    The look-ahead takes ``k`` characters, the match itself moves on by one.
    """
    pattern = f"(?s)(?=(.{{{k}}}))."
    return F.array_distinct(F.regexp_extract_all(F.array_join(tokens, " "), F.lit(pattern), 1))


def word_runs(tokens: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` words, each as the hash of its words; fewer words have none.

    ``tokens`` should be a column, not an expression: it is looked at once per run."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (k - 1))
    runs = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, F.lit(k))))
    return F.array_distinct(F.when(F.size(tokens) >= k, runs).otherwise(F.array().cast("array<bigint>")))
