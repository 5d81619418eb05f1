"""Compare registered queries with their SQL: ``python tests/oracle_check.py [folder] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from sparkbourse.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normalised(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if query and SQL agree, else what differs."""
    df = queries()[name](spark, folder)
    got = normalised(df.collect(), df.columns)
    result = con.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = normalised(result.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = list(set(got) - set(want))[:2], list(set(want) - set(got))[:2]
        return f"{len(got)} rows against {len(want)}; only here {extra}; only in SQL {missing}"
    return None if got else "no rows"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        start = time.time()
        if name in oracle_sql():
            fault = compare(spark, con, folder, name)
        else:
            fault = f"(no SQL) {queries()[name](spark, folder).count()} rows"
        print(f"{'ok ' if fault is None else '-- '} {name} {time.time() - start:.1f}s {fault or ''}", flush=True)
