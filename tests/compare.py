"""Row-by-row comparison of a Spark result with its SQL oracle."""

from __future__ import annotations

import decimal
import glob
import os
from collections import Counter

import duckdb


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("num", value.normalize() + 0)
    if isinstance(value, int) and not isinstance(value, bool):
        return ("num", decimal.Decimal(value))
    return value


def as_bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, sf_dir: str, sql: str) -> tuple[int, list]:
    """Row count of the Spark result and a few rows only one side has."""
    names, rows = oracle_rows(sf_dir, sql)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    ours, theirs = as_bag(df.columns, got), as_bag(names, rows)
    only_ours, only_theirs = ours - theirs, theirs - ours
    return len(got), [("spark", x) for x in list(only_ours)[:2]] + [("oracle", x) for x in list(only_theirs)[:2]]
