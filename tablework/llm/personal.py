"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans; labelers (shape, check, gazetteer, context, edges) vote on each;
expectation-maximisation estimates how far each labeler can be trusted; a span classifier is
trained on the resulting probabilities and decides on the spans that no base rule settles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.plans import stage

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "check", "gazetteer", "context", "edges")

#: Characters of text before and after a span that the labelers see.
LEFT, RIGHT = 48, 16
#: Buckets into which each feature of the span classifier is hashed, and the spans of each truth that
#: are taken for granted, with the features of all spans.
BUCKETS, SMOOTHING = 4096, 10
#: Rounds of expectation-maximisation at most, and the change of log odds that ends it.
ROUNDS, SETTLED = 25, 1e-2

_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_WIDE_LOCAL, _WIDE_DOMAIN = r"\p{L}\p{N}._%+-", r"\p{L}\p{N}-"
_AT, _DOT = r" ?[\[({](?i:at)[\])}] ?", r" ?[\[({](?i:dot)[\])}] ?"

# The base rules. They find what their plain forms find: a run is taken whole (possessive) and
# begins where no run goes on, or where the last match ended, so time is linear in the text.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Spans that people write as well: letters of any script, "(at)" and "[dot]", masked dots and
# addresses of eight groups, cards next to other numbers, numbers without a plus.
WIDE = {
    "email": rf"(?:\G|(?<![{_WIDE_LOCAL}]))[{_WIDE_LOCAL}]++(?:@|{_AT})[{_WIDE_DOMAIN}]++(?:(?:\.|{_DOT})[{_WIDE_DOMAIN}]++)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3})(?![0-9A-Za-z:])",
    "card": r"[0-9](?<![0-9]{2})(?:[0-9]{3}(?:[ .-]?[0-9]{4}){3}|(?<=3)[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{4,5})(?![0-9])",
    "phone": r"(?=[+0-9(])(?<![0-9A-Za-z+(])(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
# What a text with a match must hold: cheaper to look for.
_NEEDS = {
    ("email", True): "@",
    ("email", False): r"@|[\[({][aA][tT][\])}]",
    ("ip", True): r"[0-9]\.[0-9]",
    ("ip", False): r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:|[\[(]\.[\])]",
    ("card", True): "[0-9](?:[ -]?[0-9]){15}",
    ("card", False): "[0-9]{4}[ .-]?[0-9]{4}",
    ("phone", True): r"\+[0-9]",
    ("phone", False): "[0-9][ .-][0-9]{4}",
}

_OCTET = r"(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Top-level domains, first digits of card issuers, reserved address ranges, calling codes.
_TOP_DOMAINS = "com|org|net|edu|gov|info|biz|io|de|fr|es|uk|it|nl|at|ch|eu|us|ca|au|jp|cn|in|br|ru|pl|se|mx|ar"
_ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[4-9]|6011|62|64|65)"
_RESERVED = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
_CALLING = r"^(?:\+|00)(?:1|7|20|27|3[0-4]|36|39|40|41|4[3-9]|5[1-8]|6[0-6]|81|82|84|86|9[0-58])"

# Words before a span that speak for its kind, and words that speak against any.
_SPEAKS_FOR = {
    "email": r"\b(?:e-?mail|mail|contact|write|correo|courriel|kontakt)",
    "ip": r"\b(?:ip|host|server|address|adresse|login|client|from)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)",
    "phone": r"\b(?:tel|phone|call|fax|mobile|cell|telefon|t[ée]l[ée]phone|tel[ée]fono)",
}
_SPEAKS_AGAINST = r"\b(?:version|release|isbn|order|serial|build|token|hash|checksum|section|figure|id)\W*$"


def _matches(kind: str, base: bool) -> Column:
    """(kind, base, before, value, left, right) per match; ``before`` is the gap to the match before."""
    gaps, hits = F.col(f"{kind}_gaps_{base}"), F.col(f"{kind}_hits_{base}")
    n = F.size(hits)
    rows = F.arrays_zip(
        hits.alias("value"), F.slice(gaps, F.lit(1), n).alias("gap"), F.slice(gaps, F.lit(2), n).alias("next")
    )
    return F.transform(
        rows,
        lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(base).alias("base"),
            F.char_length(x["gap"]).cast("long").alias("before"),
            x["value"].alias("value"),
            F.right(x["gap"], F.lit(LEFT)).alias("left"),
            F.left(x["next"], F.lit(RIGHT)).alias("right"),
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _by_kind(choices: dict[str, Column]) -> Column:
    """The choice of the row's kind."""
    out = F.when(F.col("kind") == 0, choices[KINDS[0]])
    for k, name in enumerate(KINDS[1:], 1):
        out = out.when(F.col("kind") == k, choices[name])
    return out


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans). Documents: rid, doc_id, found; spans: rid, kind (its number), start, end
    (code points, end exclusive), value, left, right, base (settled by a base rule).

    One pass over the texts, written as a narrow table. Base matches that fail their rule go, and
    wide matches inside a base span.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = [F.col("doc_id")]
    for kind in KINDS:
        for base, pattern in ((True, BASE[kind]), (False, WIDE[kind])):
            able = body.rlike(_NEEDS[kind, base])
            hits = F.when(able, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
            cut.append(F.when(able, F.split(body, pattern, -1)).otherwise(F.array(F.lit(""))).alias(f"{kind}_gaps_{base}"))
            cut.append(hits.alias(f"{kind}_hits_{base}"))
    found = F.concat(*[_matches(kind, base) for kind in KINDS for base in (True, False)])
    rows = stage(
        docs.select(*cut).select(F.monotonically_increasing_id().alias("rid"), "doc_id", found.alias("found")), "found"
    )
    spans = rows.filter(F.size("found") > 0).select("rid", F.posexplode("found").alias("at", "m")).select("rid", "at", "m.*")
    length = F.char_length("value").cast("long")
    before = Window.partitionBy("rid", "kind", "base").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("end", F.sum(F.col("before") + length).over(before)).withColumn("start", F.col("end") - length)
    valid = _by_kind(
        {
            "email": F.lit(True),
            "ip": F.col("value").rlike(rf"^0*{_OCTET}(?:\.0*{_OCTET}){{3}}$"),
            "card": _luhn(_digits(F.col("value"))),
            "phone": F.length(_digits(F.col("value"))).between(8, 15),
        }
    )
    spans = spans.filter(~F.col("base") | valid)
    same = Window.partitionBy("rid", "kind").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    reached = F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(same), F.lit(-1))
    spans = spans.withColumn("reached", reached).filter(F.col("base") | (F.col("reached") < F.col("end")))
    return rows, spans.select("rid", "kind", "start", "end", "value", "left", "right", "base")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def votes(spans: DataFrame) -> DataFrame:
    """``spans`` with a column of -1, 0 (no opinion) or 1 per labeler."""
    value, digits = F.col("value"), _digits(F.col("value"))
    no, left = F.lit(False), F.lower("left")
    shape = _by_kind(
        {
            "email": value.rlike(rf"^[{_WIDE_LOCAL}]++@(?:[{_WIDE_DOMAIN}]++\.)++[A-Za-z]{{2,24}}$"),
            "ip": value.rlike(r"^[1-9][0-9]{0,2}(?:\.(?:0|[1-9][0-9]{0,2})){3}$") | value.contains(":"),
            "card": value.rlike(r"^[0-9]{13,19}$") | value.rlike(r"^[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}$"),
            "phone": value.rlike(r"^(?:\+|00)[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]+(?:[ .-][0-9]+){0,5}$"),
        }
    )
    check = _by_kind(
        {
            "email": value.rlike(r"[.\])} ][A-Za-z]{2,24}$"),
            "ip": value.contains(":") | F.translate("value", "[]()", "").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
            "card": _luhn(digits) & F.length(digits).between(13, 19),
            "phone": F.length(digits).between(8, 15),
        }
    )
    listed = _by_kind(
        {
            "email": F.lower(value).rlike(rf"[.\])}} ](?:{_TOP_DOMAINS})$"),
            "ip": ~value.rlike(_RESERVED),
            "card": digits.rlike(_ISSUERS),
            "phone": value.rlike(_CALLING),
        }
    )
    unlisted = _by_kind({"email": no, "ip": value.rlike(_RESERVED), "card": ~digits.rlike(_ISSUERS), "phone": no})
    said = _by_kind({k: left.rlike(p) for k, p in _SPEAKS_FOR.items()})
    joined = F.col("left").rlike(r"[\p{L}\p{N}_=/]$") | F.col("right").rlike(r"^(?:[\p{L}\p{N}_@/]|[.:-][0-9])")
    return spans.select(
        "*",
        _vote(shape, ~shape).alias("shape"),
        _vote(check, ~check).alias("check"),
        _vote(listed, unlisted).alias("gazetteer"),
        _vote(said, left.rlike(_SPEAKS_AGAINST)).alias("context"),
        _vote(~joined, joined).alias("edges"),
    )


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _posterior(odds: dict[tuple[int, str, int], float], prior: dict[int, float]) -> Column:
    """The probability of a truth by the log odds of the prior and of each vote, all literals."""
    kinds = range(len(KINDS))
    terms = [f"array({', '.join(f'{prior[k]!r}D' for k in kinds)})[kind]"]
    for name in LABELERS:
        values = ", ".join(f"{odds[k, name, v]!r}D" for k in kinds for v in (-1, 0, 1))
        terms.append(f"array({values})[kind * 3 + {name} + 1]")
    return _probability(F.expr(" + ".join(terms)))


def reliabilities(voted: DataFrame, rounds: int = ROUNDS) -> Column:
    """The probability, as an expression of the votes, that a span is what its kind says.

    Expectation-maximisation over a hidden truth per span: labelers err independently of each
    other, with a rate per kind, truth and vote. Spans count only by their votes, so the rounds
    run over at most 4 * 3^5 rows; the driver sees a row per kind, labeler and vote. The start
    is the check's vote, as that of a rule; pseudo-counts (4 for agreeing with the truth, 2 for
    no opinion, 1 for the contrary) hold a labeler with little to say above chance.
    """
    patterns = stage(voted.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).coalesce(1), "patterns").coalesce(1)
    expectation = 0.5 + 0.4 * F.col("check")
    one_each = F.array(*[F.struct(F.lit(name).alias("labeler"), F.col(name).alias("vote")) for name in LABELERS])
    odds, prior = {}, {}
    for _ in range(rounds):
        rows = (
            patterns.select("kind", "n", (F.col("n") * expectation).alias("true"), F.explode(one_each).alias("v"))
            .groupBy("kind", "v.labeler", "v.vote")
            .agg(F.sum("true").alias("true"), F.sum("n").alias("n"))
            .collect()
        )
        before, odds, prior = odds, {}, {}
        for k in range(len(KINDS)):
            seen = {(r.labeler, r.vote): (r.true, r.n - r.true) for r in rows if r.kind == k}
            for name in LABELERS:
                good, bad = ({v: seen.get((name, v), (0, 0))[t] + pseudo[v] for v in (-1, 0, 1)} for t, pseudo in enumerate(_PSEUDO))
                for v in (-1, 0, 1):
                    odds[k, name, v] = math.log(good[v] / sum(good.values()) * sum(bad.values()) / bad[v])
            true, false = (sum(seen.get((LABELERS[0], v), (0, 0))[t] for v in (-1, 0, 1)) + 1 for t in (0, 1))
            prior[k] = math.log(true / false)
        expectation = _posterior(odds, prior)
        if before and max(abs(before[x] - odds[x]) for x in odds) < SETTLED:
            break
    return expectation


_PSEUDO = ({-1: 1, 0: 2, 1: 4}, {-1: 4, 0: 2, 1: 1})


def features(spans: DataFrame) -> Column:
    """The bucket of each feature of a span: shape, length, word before, characters around, check, list."""
    shape = F.regexp_replace(F.regexp_replace("value", "[0-9]+", "9"), r"\p{L}+", "a")
    word = F.regexp_extract(F.lower("left"), r"([\p{L}]+)[^\p{L}]*$", 1)
    length = F.floor(F.log2(F.char_length("value").cast("double")) * 4)
    around = [F.regexp_extract("left", r"(?s)(.)$", 1), F.regexp_extract("right", r"(?s)^(.)", 1)]
    parts = [F.left(shape, F.lit(64)), length.cast("string"), word, *around, *[F.col(c).cast("string") for c in ("check", "gazetteer")]]
    slots = [F.concat(F.lit(f"{i}:"), F.coalesce(p, F.lit(""))) for i, p in enumerate(parts)]
    return F.array(*[(F.lit(i * BUCKETS) + F.pmod(F.xxhash64(s), F.lit(BUCKETS))).cast("int") for i, s in enumerate(slots)])


def classify(spans: DataFrame, probability: Column) -> DataFrame:
    """``spans`` with ``score``: the span classifier's probability, trained on ``probability``.

    A Naive Bayes model with expected counts: per kind, every feature adds the logarithm of its
    share among true spans over that among false ones. Counts are whole millionths, so the sums
    do not depend on their order. The model has at most 4 * 7 * BUCKETS rows and is broadcast.
    """
    spans = stage(
        spans.select("*", features(spans).alias("features"), F.round(probability * 1_000_000).cast("long").alias("true")), "voted"
    )
    totals = spans.groupBy("kind").agg(F.sum("true").alias("all_true"), F.count("*").alias("all"))
    counts = (
        spans.select("kind", "true", F.explode("features").alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("true").alias("n_true"), F.count("*").alias("n"))
    )
    true, false = F.col("n_true") / 1e6, F.col("n") - F.col("n_true") / 1e6
    all_true, all_false = F.col("all_true") / 1e6, F.col("all") - F.col("all_true") / 1e6
    granted = F.col("n") / F.col("all") * SMOOTHING
    # one row per kind and bucket: bounded
    model = stage(
        counts.join(F.broadcast(totals), "kind").select(
            "kind",
            "feature",
            F.log((true + granted) / (all_true + SMOOTHING) * (all_false + SMOOTHING) / (false + granted)).alias("weight"),
            F.log((all_true + 1) / (all_false + 1)).alias("prior"),
        ),
        "span_model",
    )
    keys = ["rid", "kind", "start", "end", "base"]
    return (
        spans.select(*keys, F.explode("features").alias("feature"))
        .join(F.broadcast(model), ["kind", "feature"])
        .groupBy(*keys)
        .agg(_probability(F.sum(F.round("weight", 6).cast("decimal(18,6)")).cast("double") + F.max("prior")).alias("score"))
    )


def find_personal(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end, base, score), by kind and start.

    ``docs``: doc_id, text; other columns are not read. Positions are code points of the whole
    text, the end exclusive. Spans of the base rules are always kept; others need a score of
    ``least``, and may overlap a base span that they exceed. Null and empty texts have no spans; null
    and repeated ids keep a row each; without documents there are no rows.

    The texts are read once and not shuffled; only spans are. A document's own spans are put in
    order in one task, and so is a document; a text with very many spans costs no more than
    sorting them.
    """
    rows, found = candidates(docs)
    voted = stage(votes(found), "votes")
    scored = classify(voted, reliabilities(voted)).filter(F.col("base") | (F.col("score") >= least))
    span = F.struct("kind", "start", "end", "base", "score")
    lists = scored.groupBy("rid").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    some = rows.filter(F.size("found") > 0).select("rid", "doc_id").join(lists, "rid", "left").select("doc_id", "spans")
    # most documents have no candidate and are not shuffled
    none = rows.filter(F.size("found") == 0).select("doc_id", F.lit(None).cast(some.schema["spans"].dataType).alias("spans"))
    name = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform(
        F.coalesce("spans", F.array().cast(some.schema["spans"].dataType)),
        lambda s: F.struct(name[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), s["score"].alias("score")),
    )
    return some.unionByName(none).select("doc_id", named.alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
