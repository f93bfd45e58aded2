"""Runs registered queries next to their SQL checks and compares whole results.

As a script: ``python tests/compare.py FOLDER [QUERY ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    relation = connection.sql(sql)
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"schema: {ours} against {theirs}"
    left, right = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"rows: {sum(left.values())} against {sum(right.values())}; "
        f"ours only {sum(only_left.values())} e.g. {list(only_left)[:2]}; theirs only {sum(only_right.values())} e.g. {list(only_right)[:2]}"
    )[:1500]


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from pairloom.session import local_session

    spark = local_session(8)
    connection = connect(folder)
    plans, checks = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or plans:
        start = time.time()
        try:
            df = plans[name](spark, folder)
            if name in checks and "--no-check" not in sys.argv:
                found = difference(df, connection, checks[name])
            else:
                found = None if df.collect() else "no rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:900]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {'' if name in checks else '(rows only)'} {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], [n for n in sys.argv[2:] if not n.startswith('--')])))
