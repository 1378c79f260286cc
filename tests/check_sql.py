"""Compare registered queries with their SQL: python tests/check_sql.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 9) + 0.0
        return value

    data = [tuple(cell(row[i]) for i in order) for row in rows]
    data.sort(key=lambda row: tuple((v is None, str(v)) for v in row))
    return [columns[i] for i in order], data


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else the first difference."""
    cursor = con.execute(sql)
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{a} != {b}"[:500]
    return None


def main() -> int:
    from tests.session import make_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), database(folder)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            df = entry.queries()[name](spark, folder)
            if sql is None:
                rows = len(df.collect())
                print(f"rows  {name:28s} {rows:8d} rows {time.time() - start:6.1f}s", flush=True)
                continue
            difference = compare(df, con, sql)
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{'equal' if difference is None else 'DIFF '} {name:28s} {time.time() - start:6.1f}s "
              f"{difference or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
