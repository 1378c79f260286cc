"""Jobs on numeric and categorical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators import clean, frequency, profile, series
from tablework.operators.sketches import RANK_ERROR, merge_sketches, quantile_sketches, sketch_quantiles
from tablework.plans import stage

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_int(sql: str, *columns: str) -> str:
    """SQL whose given columns are 32-bit integers, as the query's are."""
    casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def profile_numeric(spark, folder):
    out = profile.profile(table(spark, folder, "lineitem"), MEASURES)
    return rounded(out, 6, "mean", "stddev")


PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in MEASURES
)


def cast_dropna(spark, folder):
    marked = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "?")
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("level"),
        F.col("o_totalprice").cast("string").alias("price"),
    )
    return clean.drop_incomplete(clean.cast_columns(marked, {"level": "int", "price": "double"}))


CAST_SQL = """
SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, o_totalprice AS price
FROM orders WHERE o_orderstatus <> 'P'
"""


def rename_project(spark, folder):
    renamed = clean.rename_by_position(
        table(spark, folder, "supplier"), ["key", "name", "nation", "balance"]
    )
    return renamed.drop("nation").select("NAME", "key", "balance").toDF("name", "key", "balance")


RENAME_SQL = "SELECT s_name AS name, s_suppkey AS key, s_acctbal AS balance FROM supplier"


def minmax_norm(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    norms = [f"norm_{c}" for c in MEASURES]
    return clean.normalise(lines, MEASURES).select("l_orderkey", "l_linenumber", *norms)


MINMAX_SQL = (
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"({c} - low_{c}) / (high_{c} - low_{c}) AS norm_{c}" for c in MEASURES)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in MEASURES)
    + " FROM lineitem)"
)


def sample_rows(spark, folder):
    return clean.sample_rows(table(spark, folder, "orders"), "o_orderkey", 0.01, 42)


SAMPLE_SQL = f"""
SELECT * FROM orders
WHERE substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '{round(0.01 * 2**32):08x}'
"""


def union_sources(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.lit("customer").alias("source"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.lit("supplier").alias("source"),
    )
    return clean.stack_tables([customers, suppliers])


UNION_SQL = """
SELECT 'customer' AS source, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL
SELECT 'supplier', s_name, s_nationkey, s_acctbal FROM supplier
"""


def row_counts(spark, folder):
    """Row count per source table."""
    names = ["customer", "events", "lineitem", "orders", "supplier"]
    return clean.stack_tables(
        [
            table(spark, folder, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n"))
            for n in names
        ]
    )


ROW_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}"
    for n in ["customer", "events", "lineitem", "orders", "supplier"]
)


def value_counts(spark, folder):
    lines = frequency.value_counts(
        table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"]
    )
    orders = frequency.value_counts(
        table(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority"]
    )
    return clean.stack_tables([lines, orders]).orderBy("column_name", F.desc("n"), "value")


VALUE_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM {t} GROUP BY {c}"
    for t, c in [
        ("lineitem", "l_returnflag"),
        ("lineitem", "l_linestatus"),
        ("orders", "o_orderstatus"),
        ("orders", "o_orderpriority"),
    ]
)


def top_value_per_group(spark, folder):
    return frequency.top_value_per_group(
        table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus"
    )


TOP_VALUE_SQL = """
SELECT o_orderpriority, o_orderstatus, n FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) AS r
  FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL))
WHERE r = 1
"""


def median_mode(spark, folder):
    """Also of a column that is null in most rows, and of one that is in all."""
    lines = table(spark, folder, "lineitem").select(
        *MEASURES,
        F.when(F.col("l_discount") == 0.1, F.col("l_tax")).alias("some_tax"),
        F.lit(None).cast("double").alias("no_tax"),
    )
    columns = [*MEASURES, "some_tax", "no_tax"]
    counts = profile.value_counts(lines, columns)
    return profile.median(lines, columns, counts).join(profile.mode(lines, columns, counts=counts), "column_name")


MEDIAN_MODE_SQL = """
SELECT 'some_tax' AS column_name, median(l_tax) AS median,
  (SELECT l_tax FROM lineitem WHERE l_discount = 0.1 GROUP BY l_tax ORDER BY count(*) DESC, l_tax LIMIT 1) AS mode,
  (SELECT count(*) FROM lineitem WHERE l_discount = 0.1 GROUP BY l_tax ORDER BY count(*) DESC LIMIT 1) AS n
FROM lineitem WHERE l_discount = 0.1
UNION ALL SELECT 'no_tax', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0
UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, median({c}) AS median, "
    f"(SELECT {c} FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode, "
    f"(SELECT count(*) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS n FROM lineitem"
    for c in MEASURES
)


def correlation(spark, folder):
    """Of two columns with nulls in different rows."""
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("price"),
    )
    return rounded(profile.correlation(lines, "quantity", "price"), 10, "corr")


CORRELATION_SQL = """
SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice), 10) AS corr FROM lineitem
WHERE l_linenumber <> 1 AND l_returnflag <> 'R'
"""


def argmax_label(spark, folder):
    return profile.arg_max(
        table(spark, folder, "orders"), "o_orderpriority", ["o_totalprice", "o_custkey", "o_orderkey"]
    )


ARGMAX_SQL = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, o_orderpriority AS label, CAST({c} AS DOUBLE) AS value "
    f"FROM orders ORDER BY {c} DESC, o_orderpriority DESC LIMIT 1)"
    for c in ["o_totalprice", "o_custkey", "o_orderkey"]
)


def score_by_group(spark, folder):
    scored = clean.add_sum(
        table(spark, folder, "lineitem").select(
            "l_returnflag",
            F.col("l_discount").cast("string").alias("first"),
            F.col("l_tax").cast("string").alias("second"),
        ),
        "first",
        "second",
        "score",
    )
    return rounded(series.sum_and_mean(scored, "l_returnflag", "score"), 6, "total", "mean")


SCORE_SQL = """
SELECT l_returnflag, round(sum(l_discount + l_tax), 6) AS total, round(avg(l_discount + l_tax), 6) AS mean
FROM lineitem GROUP BY l_returnflag
"""


def series_means(spark, folder):
    """Every user's events as wide series of two days, 144 slots of 20 minutes each."""
    day = F.datediff("ts", F.lit("1970-01-01"))
    # pmod: days before 1970 are negative
    slots = table(spark, folder, "events").select(
        "user_id",
        F.floor(day / 2).alias("span"),
        (F.pmod(day, F.lit(2)) * 72 + F.hour("ts") * 3 + F.floor(F.minute("ts") / 20) + 1)
        .cast("int")
        .alias("slot"),
        F.lit(1).alias("one"),
    )
    wide = series.widen(slots, ["user_id", "span"], "slot", "one")
    names = series.slot_names()
    filled = F.filter(F.array(*[F.when(F.col(c) > 0, F.lit(i + 1)) for i, c in enumerate(names)]), lambda x: x.isNotNull())
    # the shape goes along as keys, so the wide rows are made once
    shaped = wide.withColumns({"slots": F.array_join(filled.cast("array<string>"), ","), "largest": F.greatest(*names)})
    return series.mean_popularity(shaped, ["user_id", "span", "slots", "largest"]).orderBy("user_id", "span")


SERIES_SQL = """
WITH s AS (
  SELECT user_id, CAST(floor(epoch(ts) / 172800) AS BIGINT) AS span,
         CAST(floor((epoch(ts) - 172800 * floor(epoch(ts) / 172800)) / 1200) AS BIGINT) + 1 AS slot, count(*) AS n
  FROM events GROUP BY ALL)
SELECT user_id, span, sum(n) / 48 AS per_hour, sum(n) / 2 AS per_day,
       string_agg(CAST(slot AS VARCHAR), ',' ORDER BY slot) AS slots, CAST(max(n) AS BIGINT) AS largest
FROM s GROUP BY user_id, span
"""

SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def merged_quantiles(spark, folder):
    """Quantiles per event type of sketches that were stored per day, and whether the true rank of
    each is within RANK_ERROR of its share."""
    events = table(spark, folder, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    daily = stage(quantile_sketches(events, ["event_type", "day"], "value"), "daily")
    found = stage(sketch_quantiles(merge_sketches(daily, ["event_type"]), SHARES), "quantiles")
    # a row per event type and share
    limits = found.select(F.col("event_type").alias("kind"), "n", "share", F.col("value").alias("limit"))
    ranked = events.join(F.broadcast(limits), F.col("event_type").eqNullSafe(F.col("kind"))).groupBy("event_type", "n", "share").agg(
        (F.sum(F.when(F.col("value") < F.col("limit"), 1).otherwise(0)) / F.col("n")).alias("below"),
        (F.sum(F.when(F.col("value") <= F.col("limit"), 1).otherwise(0)) / F.col("n")).alias("up_to"),
    )
    within = (F.col("below") - RANK_ERROR <= F.col("share")) & (F.col("share") <= F.col("up_to") + RANK_ERROR)
    return ranked.select("event_type", "n", "share", within.alias("within"))


MERGED_QUANTILES_SQL = f"""
SELECT event_type, count(*) AS n, CAST(share AS DOUBLE) AS share, true AS within
FROM events, (SELECT unnest([{", ".join(str(s) for s in SHARES)}]) AS share)
WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL
"""

QUERIES = {
    "merged_quantiles": merged_quantiles,
    "profile_numeric": profile_numeric,
    "cast_dropna": cast_dropna,
    "rename_project": rename_project,
    "minmax_norm": minmax_norm,
    "sample_rows": sample_rows,
    "union_sources": union_sources,
    "row_counts": row_counts,
    "value_counts": value_counts,
    "top_value_per_group": top_value_per_group,
    "median_mode": median_mode,
    "correlation": correlation,
    "argmax_label": argmax_label,
    "score_by_group": score_by_group,
    "series_means": series_means,
}

SQL = {
    "merged_quantiles": MERGED_QUANTILES_SQL,
    "profile_numeric": PROFILE_SQL,
    "cast_dropna": CAST_SQL,
    "rename_project": RENAME_SQL,
    "minmax_norm": MINMAX_SQL,
    "sample_rows": SAMPLE_SQL,
    "union_sources": UNION_SQL,
    "row_counts": ROW_COUNTS_SQL,
    "value_counts": VALUE_COUNTS_SQL,
    "top_value_per_group": TOP_VALUE_SQL,
    "median_mode": MEDIAN_MODE_SQL,
    "correlation": CORRELATION_SQL,
    "argmax_label": ARGMAX_SQL,
    "score_by_group": SCORE_SQL,
    "series_means": SERIES_SQL,
}
