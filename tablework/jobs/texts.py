"""Jobs on texts: extraction, tokens, shingle sets, signatures, near-duplicate pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablework.functions.hashing import PRIME, SHINGLE_BASE, MinHashFamily
from tablework.functions.text import (
    STORY_EDGES,
    STORY_WORD,
    TOKEN_EDGES,
    blocks_between,
    letter_tokens,
    story_tokens,
)
from tablework.jobs.tables import table, with_int
from tablework.operators import lsh, minhash, postings, sets
from tablework.operators.clean import stack_tables
from tablework.plans import spread, stage
from tablework.plans.components import components

FAMILY = MinHashFamily(size=100, seed=7)
BANDS, THRESHOLD, K = 20, 0.8, 5


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SPACE_RE = "[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+"
TOKENS_SQL = f"""
tokens AS (SELECT doc_id, list_filter(
  list_transform(regexp_split_to_array(text, '{SPACE_RE}'),
                 lambda t: trim(lower(t), {_quoted(TOKEN_EDGES)})),
  lambda t: regexp_full_match(t, '\\p{{L}}{{1,26}}')) AS tokens FROM documents)
"""
CHARS_SQL = f"""
{TOKENS_SQL},
lines AS (SELECT doc_id, array_to_string(tokens, ' ') AS line FROM tokens),
chars AS (SELECT doc_id, unnest(range(length(line))) AS i, unnest(string_split(line, '')) AS c
          FROM lines WHERE length(line) > 0),
runs AS (SELECT doc_id, c AS c1, lead(c, 1) OVER w AS c2, lead(c, 2) OVER w AS c3,
                lead(c, 3) OVER w AS c4, lead(c, 4) OVER w AS c5
         FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY c5 IS NOT NULL)
"""
SETS_SQL = f"""
{CHARS_SQL},
shingles AS (SELECT DISTINCT doc_id, c1 || c2 || c3 || c4 || c5 AS shingle FROM runs)
"""


def _number(chars: list[str]) -> str:
    value = "0"
    for c in chars:
        value = f"(({value}) * CAST({SHINGLE_BASE} AS BIGINT) + ord({c})) % {PRIME}"
    return value


SIGNATURES_SQL = (
    f"{CHARS_SQL}, numbers AS (SELECT DISTINCT doc_id, CAST({_number(['c1', 'c2', 'c3', 'c4', 'c5'])} "
    "AS BIGINT) AS x FROM runs), signatures AS MATERIALIZED (SELECT doc_id, ["
    + ", ".join(f"min(({a} * x + {b}) % {PRIME})" for a, b in FAMILY.coefficients)
    + "] AS sig FROM numbers GROUP BY doc_id)"
)
GROUPS_SQL = f"""
{SIGNATURES_SQL},
groups AS MATERIALIZED (SELECT min(doc_id) AS rep, count(*) AS copies, sig FROM signatures GROUP BY sig)
"""
CANDIDATES_SQL = f"""
{GROUPS_SQL},
bands AS (SELECT rep, j, sha1(array_to_string(list_slice(sig, j * 5 + 1, j * 5 + 5), ',')) AS key
          FROM groups, (SELECT unnest(range({BANDS})) AS j)),
found AS (SELECT DISTINCT x.rep AS a, y.rep AS b
          FROM bands x JOIN bands y ON x.j = y.j AND x.key = y.key AND x.rep < y.rep),
scored AS (SELECT a, b, list_sum(list_transform(range(1, 101), lambda i: CAST(x.sig[i] = y.sig[i] AS INTEGER)))
                        / 100 AS agreement
           FROM found JOIN groups x ON x.rep = a JOIN groups y ON y.rep = b),
candidates AS MATERIALIZED (
  SELECT a, b, agreement FROM scored WHERE agreement >= {THRESHOLD}
  UNION ALL
  SELECT x.rep, s.doc_id, 1.0 FROM signatures s JOIN groups x ON x.sig = s.sig AND x.rep <> s.doc_id)
"""


def extract_blocks(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "html")
    return pages.select(
        "page_id", F.posexplode_outer(blocks_between("html", "<p>", "</p>")).alias("pos", "text")
    ).filter(F.col("pos").isNotNull())


EXTRACT_SQL = """
SELECT page_id, unnest(range(len(found))) AS pos, unnest(found) AS text
FROM (SELECT page_id, regexp_extract_all(html, '<p>(.*?)</p>', 1, 's') AS found FROM pages)
"""


def _token_lines(df, row_id, tokens):
    return df.select(row_id, tokens.alias("tokens")).select(
        row_id,
        F.size("tokens").alias("n_tokens"),
        F.array_join("tokens", " ").alias("line"),
    )


def tokens_alpha(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return _token_lines(documents, "doc_id", letter_tokens("text"))


ALPHA_SQL = f"""
WITH {TOKENS_SQL}
SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS line FROM tokens
"""


def tokens_word(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return _token_lines(documents, "doc_id", story_tokens("text"))


WORD_SQL = f"""
SELECT doc_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS line FROM (
  SELECT doc_id, regexp_extract_all(
    regexp_replace(replace(trim(lower(text), {_quoted(STORY_EDGES)}), '{STORY_WORD}', ''),
                   '<[^\\n]*?>', '', 'g'), '[\\p{{L}}\\p{{N}}_]+') AS tokens FROM documents)
"""


def tokens_pages(spark, folder):
    """Letter tokens of whole pages, entities decoded."""
    pages = spread(table(spark, folder, "pages").select("page_id", "html"))
    return _token_lines(pages, "page_id", letter_tokens("html"))


# The entities that occur in the pages.
PAGES_SQL = f"""
WITH decoded AS (SELECT page_id, regexp_replace(
  replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
  '&amp;?', '&', 'g') AS html FROM pages),
tokens AS (SELECT page_id, list_filter(
  list_transform(regexp_split_to_array(html, '{SPACE_RE}'),
                 lambda t: trim(lower(t), {_quoted(TOKEN_EDGES)})),
  lambda t: regexp_full_match(t, '\\p{{L}}{{1,26}}')) AS tokens FROM decoded)
SELECT page_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS line FROM tokens
"""


def document_sets(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return sets.shingle_sets(documents, "doc_id", "text", K)


def shingle_counts(spark, folder):
    return document_sets(spark, folder).select("doc_id", F.size("shingles").alias("n"))


COUNTS_SQL = f"""
WITH {SETS_SQL}
SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
"""


def shingle_vocab(spark, folder):
    return sets.shingle_index(document_sets(spark, folder)).select("shingle", "idx")


VOCAB_SQL = f"""
WITH {SETS_SQL}
SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS idx
FROM (SELECT DISTINCT shingle FROM shingles)
"""


def shingle_matrix(spark, folder):
    """Per document: how many ones its row of the 0/1 matrix has and where they lie."""
    # cutting the texts a second time is cheaper than keeping all sets, several times their size
    found = document_sets(spark, folder)
    ones = sets.shingle_matrix(found, "doc_id", sets.shingle_index(found))
    return ones.groupBy("doc_id").agg(
        F.count("*").alias("ones"),
        F.min("idx").alias("first_idx"),
        F.max("idx").alias("last_idx"),
        F.sum("idx").alias("sum_idx"),
    )


SHINGLE_MATRIX_SQL = f"""
WITH {SETS_SQL},
vocabulary AS (SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS idx
               FROM (SELECT DISTINCT shingle FROM shingles))
SELECT doc_id, count(*) AS ones, min(idx) AS first_idx, max(idx) AS last_idx,
       CAST(sum(idx) AS BIGINT) AS sum_idx
FROM shingles JOIN vocabulary USING (shingle) GROUP BY doc_id
"""


def shingle_matrix_corner(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return sets.matrix_corner(documents, "doc_id", "text", 100, K)


CORNER_SQL = f"""
WITH {SETS_SQL},
v AS (SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS idx
      FROM (SELECT DISTINCT shingle FROM shingles) QUALIFY idx < 100),
d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS col FROM documents QUALIFY col < 100)
SELECT idx, shingle, col, doc_id,
       CAST(EXISTS (SELECT 1 FROM shingles s WHERE s.doc_id = d.doc_id AND s.shingle = v.shingle)
            AS INTEGER) AS present
FROM v, d
"""


def shingle_corner_lines(spark, folder):
    """The corner with one row per shingle and one 0/1 column per document."""
    return sets.corner_lines(shingle_matrix_corner(spark, folder), "doc_id", 100)


CORNER_LINES_SQL = (
    "SELECT idx, shingle, "
    + ", ".join(f"max(present) FILTER (col = {i}) AS d{i}" for i in range(100))
    + f" FROM ({CORNER_SQL}) GROUP BY idx, shingle"
)


def document_signatures(spark, folder):
    return minhash.text_signatures(table(spark, folder, "documents"), "doc_id", "text", FAMILY, K)


def minhash_signature(spark, folder):
    return minhash.signature_cells(document_signatures(spark, folder), "doc_id")


SIGNATURE_SQL = f"""
WITH {SIGNATURES_SQL} SELECT doc_id, unnest(range(100)) AS i, unnest(sig) AS value FROM signatures
"""


def signature_copies(spark, folder):
    """Every document with the representative of its equal signatures."""
    signatures = stage(document_signatures(spark, folder), "signatures")
    return lsh.copy_members(signatures, lsh.copy_groups(signatures, "doc_id"), "doc_id")


COPIES_SQL = f"WITH {GROUPS_SQL} SELECT doc_id, rep FROM signatures JOIN groups USING (sig)"


def lsh_candidates(spark, folder):
    """Pairs of documents; a copy is paired with the first of its copies, which stands for it."""
    return lsh.document_links(document_signatures(spark, folder), "doc_id", BANDS, THRESHOLD)


LSH_SQL = f"WITH {CANDIDATES_SQL} SELECT * FROM candidates"


def lsh_candidates_blocks(spark, folder):
    """The same pairs with all buckets of three and more compared block by block."""
    signatures = document_signatures(spark, folder)
    return lsh.document_links(signatures, "doc_id", BANDS, THRESHOLD, bucket_limit=3)


def lsh_verified(spark, folder):
    pairs = stage(lsh_candidates(spark, folder), "pairs")
    return lsh.verified_pairs(pairs, table(spark, folder, "documents"), "doc_id", "text", K)


VERIFIED_SQL = f"""
WITH {CANDIDATES_SQL},
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, c1 || c2 || c3 || c4 || c5 AS shingle FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a, b, count(*) AS shared FROM candidates JOIN shingles x ON x.doc_id = a
           JOIN shingles y ON y.doc_id = b AND y.shingle = x.shingle GROUP BY a, b)
SELECT a, b, shared / (p.n + q.n - shared) AS jaccard
FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
"""


def lsh_components(spark, folder):
    """Every document with the smallest document that a chain of pairs leads to."""
    links = components(stage(lsh_candidates(spark, folder), "pairs"))
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("node"))
    return documents.join(links, "node", "left").select(
        F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("component")
    )


COMPONENTS_SQL = f"""
WITH RECURSIVE {CANDIDATES_SQL},
both_ways AS MATERIALIZED (SELECT a, b FROM candidates UNION SELECT b, a FROM candidates),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT x, b FROM reach JOIN both_ways ON y = a)
SELECT x AS doc_id, min(y) AS component FROM reach GROUP BY x
"""


def lsh_neighbours(spark, folder):
    lists = lsh.neighbour_lists(stage(lsh_candidates(spark, folder), "pairs"))
    joined = F.array_join(F.transform("neighbours", lambda b: b.cast("string")), ",")
    return lists.select("a", "line", joined.alias("neighbours"))


NEIGHBOURS_SQL = f"""
WITH {CANDIDATES_SQL}
SELECT a, CAST(line AS INTEGER) AS line, string_agg(CAST(b AS VARCHAR), ',' ORDER BY b) AS neighbours
FROM (SELECT a, b, (row_number() OVER (PARTITION BY a ORDER BY b) - 1) // 1000 AS line FROM candidates)
GROUP BY a, line
"""

def merged_signatures(spark, folder):
    """Signatures of every source, language and the whole table, merged from those stored per source and language."""
    groups = table(spark, folder, "documents").select("doc_id", "source", "lang")
    texts = document_signatures(spark, folder).join(groups, "doc_id")
    stored = stage(minhash.merge_signatures(texts, ["source", "lang"], FAMILY.size), "parts")
    levels = (
        ("source", minhash.merge_signatures(stored, ["source"], FAMILY.size).withColumnRenamed("source", "name")),
        ("lang", minhash.merge_signatures(stored, ["lang"], FAMILY.size).withColumnRenamed("lang", "name")),
        ("all", minhash.merge_signatures(stored, [], FAMILY.size).withColumn("name", F.lit(""))),
    )
    line = F.array_join(F.col("sig").cast("array<string>"), ",")
    return stack_tables([df.select(F.lit(level).alias("level"), "name", line.alias("sig")) for level, df in levels])


_LEAST_SQL = "array_to_string([" + ", ".join(f"min(({a} * x + {b}) % {PRIME})" for a, b in FAMILY.coefficients) + "], ',') AS sig"
MERGED_SIGNATURES_SQL = f"""
WITH {SIGNATURES_SQL}, n AS (SELECT DISTINCT source, lang, x FROM numbers JOIN documents USING (doc_id))
SELECT 'source' AS level, source AS name, {_LEAST_SQL} FROM n GROUP BY source
UNION ALL SELECT 'lang', lang, {_LEAST_SQL} FROM n GROUP BY lang
UNION ALL SELECT 'all', '', {_LEAST_SQL} FROM n
"""

def document_postings(spark, folder):
    found = document_sets(spark, folder)
    ones = sets.shingle_matrix(found, "doc_id", sets.shingle_index(found))
    return postings.posting_lists(ones, "doc_id", span=256)


def posting_lists(spark, folder):
    """The transposed 0/1 matrix as inverted lists: per shingle and segment of 256 ids the steps between its documents."""
    lists = document_postings(spark, folder)
    return lists.withColumn("deltas", F.array_join(F.col("deltas").cast("array<string>"), ","))


_INDEX_SQL = f"""
WITH {SETS_SQL},
vocabulary AS (SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS idx FROM (SELECT DISTINCT shingle FROM shingles)),
ones AS MATERIALIZED (SELECT idx, doc_id FROM shingles JOIN vocabulary USING (shingle))
"""
POSTINGS_SQL = f"""
{_INDEX_SQL},
steps AS (SELECT idx, doc_id // 256 AS segment, doc_id, doc_id - coalesce(lag(doc_id) OVER w, doc_id // 256 * 256) AS step
          FROM ones WINDOW w AS (PARTITION BY idx, doc_id // 256 ORDER BY doc_id))
SELECT idx, segment, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(step AS VARCHAR), ',' ORDER BY doc_id) AS deltas
FROM steps GROUP BY idx, segment
"""


def posting_pairs(spark, folder):
    """In how many documents a shingle lies together with the next one of the vocabulary, from the inverted lists."""
    lists = stage(document_postings(spark, folder), "lists")
    names = lists.select("idx").distinct()
    following = names.select((F.col("idx") + 1).alias("b")).join(names.select(F.col("idx").alias("b")), "b")
    return postings.shared_rows(lists, stage(following.select((F.col("b") - 1).alias("a"), "b"), "pairs"))


POSTING_PAIRS_SQL = f"""
{_INDEX_SQL},
v AS (SELECT idx, idx + 1 AS next FROM vocabulary WHERE idx < (SELECT max(idx) FROM vocabulary)),
n AS (SELECT x.idx AS a, count(*) AS n FROM ones x JOIN ones y ON x.doc_id = y.doc_id AND y.idx = x.idx + 1 GROUP BY ALL)
SELECT v.idx AS a, v.next AS b, coalesce(n, 0) AS n FROM v LEFT JOIN n ON n.a = v.idx
"""

QUERIES = {
    "posting_lists": posting_lists,
    "posting_pairs": posting_pairs,
    "merged_signatures": merged_signatures,
    "extract_blocks": extract_blocks,
    "tokens_alpha": tokens_alpha,
    "tokens_word": tokens_word,
    "tokens_pages": tokens_pages,
    "shingle_counts": shingle_counts,
    "shingle_vocab": shingle_vocab,
    "shingle_matrix": shingle_matrix,
    "shingle_matrix_corner": shingle_matrix_corner,
    "shingle_corner_lines": shingle_corner_lines,
    "minhash_signature": minhash_signature,
    "signature_copies": signature_copies,
    "lsh_candidates": lsh_candidates,
    "lsh_candidates_blocks": lsh_candidates_blocks,
    "lsh_verified": lsh_verified,
    "lsh_components": lsh_components,
    "lsh_neighbours": lsh_neighbours,
}

SQL = {
    "posting_lists": POSTINGS_SQL,
    "posting_pairs": POSTING_PAIRS_SQL,
    "merged_signatures": MERGED_SIGNATURES_SQL,
    "extract_blocks": with_int(EXTRACT_SQL, "pos"),
    "tokens_alpha": with_int(ALPHA_SQL, "n_tokens"),
    "tokens_word": with_int(WORD_SQL, "n_tokens"),
    "tokens_pages": with_int(PAGES_SQL, "n_tokens"),
    "shingle_counts": with_int(COUNTS_SQL, "n"),
    "shingle_vocab": VOCAB_SQL,
    "shingle_matrix": SHINGLE_MATRIX_SQL,
    "shingle_matrix_corner": with_int(CORNER_SQL, "idx", "col"),
    "shingle_corner_lines": with_int(CORNER_LINES_SQL, "idx"),
    "minhash_signature": with_int(SIGNATURE_SQL, "i"),
    "signature_copies": COPIES_SQL,
    "lsh_candidates": LSH_SQL,
    "lsh_candidates_blocks": LSH_SQL,
    "lsh_verified": VERIFIED_SQL,
    "lsh_components": COMPONENTS_SQL,
    "lsh_neighbours": NEIGHBOURS_SQL,
}
