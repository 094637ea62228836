"""Run named queries next to their SQL on DuckDB and compare the rows.

As a script: ``python tests/oracle.py <folder> [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, (datetime, date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, folder: str, name: str, function, sql: str | None):
    started = time.time()
    df = function(spark, folder)
    got_names, got = rows_of(df.columns, df.collect())
    spent = time.time() - started
    if sql is None:
        return True, f"{len(got)} rows, no oracle", spent
    result = con.execute(sql)
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} / {want_names}", spent
    if len(got) != len(want):
        return False, f"{len(got)} / {len(want)} rows; {got[:2]} / {want[:2]}", spent
    for a, b in zip(got, want):
        if a != b:
            return False, f"first difference\n   {a}\n   {b}", spent
    return True, f"{len(got)} rows", spent


if __name__ == "__main__":
    from trellis.plans.catalog import ORACLES, QUERIES
    from trellis.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8, memory="12g")
    con = connect(folder)
    bad = 0
    for name, function in QUERIES.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, note, spent = compare(spark, con, folder, name, function, ORACLES.get(name))
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            ok, note, spent = False, f"{type(error).__name__}: {str(error)[:700]}", 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {spent:6.2f}s {name}: {note}", flush=True)
    print("bad:", bad)
