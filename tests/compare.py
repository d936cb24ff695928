"""Runs registered queries beside their SQL counterpart and compares every row.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_plain(x) for x in v))
    return v


def bag(columns, rows) -> tuple:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty if the query's rows equal the SQL's, as bags and with equal column names and types."""
    got_cols, got = bag(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = bag([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return [f"columns: only here {sorted(set(got_cols) - set(want_cols))}, "
                f"only in SQL {sorted(set(want_cols) - set(got_cols))}"]
    if got == want:
        return []
    extra, missing = got - want, want - got
    out = [f"rows {sum(got.values())} vs {sum(want.values())}, {sum(extra.values())} extra, {sum(missing.values())} missing"]
    for a, b in list(zip(sorted(extra, key=str), sorted(missing, key=str)))[:2]:
        out += [f"  {c}: {x!r} vs {y!r}" for c, x, y in zip(got_cols, a, b) if x != y]
    if not missing or not extra:
        out.append(f"  {next(iter(extra or missing))}")
    return out


def main(argv) -> int:
    from __spark_entry__ import oracle_sql, queries
    from leadvault.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name in wanted:
        began = time.monotonic()
        try:
            df = queries()[name](spark, sf_dir)
            if name in sqls:
                found = differences(df, con, sqls[name])
            else:
                found = [] if df.count() >= 0 else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        mark = "BAD " if found else ("ok  " if name in sqls else "rows")
        print(f"{mark} {name} {time.monotonic() - began:.1f}s", *found, sep="\n    " if found else " ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
