"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from gridscope_checks import QUERIES, SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

KINDS = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "bigint", "varchar": "string",
         "varchar[]": "array<string>", "hugeint": "hugeint"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("f", "nan") if math.isnan(value) else ("f", repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value.normalize()))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("t", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("l", tuple(_plain(v) for v in value))
    return (type(value).__name__, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf)
    ours = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if name not in SQL:
        return bool(ours), f"{len(ours)} rows, no SQL, {spent:.1f}s"
    start = time.time()
    result = con.execute(SQL[name])
    names, kinds = [c[0] for c in result.description], [str(c[1]).lower() for c in result.description]
    theirs = result.fetchall()
    note = f"{len(ours)} rows, spark {spent:.1f}s, duckdb {time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    spark_kinds = dict(df.dtypes)
    kind_gaps = {n: (spark_kinds[n], k) for n, k in zip(names, kinds) if spark_kinds[n] != KINDS.get(k, k)}
    a, b = _rows(df.columns, ours), _rows(names, theirs)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [r for r in a if r not in in_b][:2], [r for r in b if r not in in_a][:2]
        return False, f"{note}\n   rows {len(a)} / {len(b)}\n   spark {only_a}\n   sql   {only_b}"
    if kind_gaps:
        return False, f"{note} types {kind_gaps}"
    return True, note


def main(sf: str, wanted: list[str]) -> int:
    from gridscope.session import local_session

    spark, con, bad = local_session(), connect(sf), []
    for name in QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            good, note = compare(spark, con, name, sf)
        except Exception as e:  # report and go on
            good, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        print("ok  " if good else "BAD ", name, note, flush=True)
        if not good:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
