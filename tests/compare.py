"""Run queries and their SQL over the same tables and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def sql_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = sorted(tuple(shown(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows


def spark_rows(df):
    names = sorted(df.columns)
    rows = sorted(tuple(shown(r[n]) for n in names) for r in df.collect())
    return names, rows


def difference(spark, con, sf: str, query, sql: str) -> str | None:
    names, got = spark_rows(query(spark, sf))
    want_names, want = sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from tickwell.session import local_session
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    sf = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = local_session(), connect(sf)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        if name not in ORACLE:
            print("NO SQL", name)
            continue
        try:
            wrong = difference(spark, con, sf, QUERIES[name], ORACLE[name])
        except Exception as e:  # noqa: BLE001
            wrong = str(e)[:600].replace("\n", " | ")
        print("WRONG" if wrong else "same", name, round(time.time() - start, 1), (wrong or "")[:700])
