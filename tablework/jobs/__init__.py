"""The registered queries: each a Spark job on the given tables and, where SQL can
say the same on whole tables, its SQL."""

from tablework.jobs import files, tables, texts, vectors, words

MODULES = (tables, words, texts, vectors, files)


def all_queries() -> dict:
    return {name: job for module in MODULES for name, job in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
