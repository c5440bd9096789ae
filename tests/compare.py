"""Run a query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(v) -> str:
    return "none" if v is None else type(v).__name__


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str, empty_ok: bool = False) -> str | None:
    """None if equal, otherwise what differs."""
    from quillrank.catalog import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    got_cols, got = normal(df.columns, df.collect())
    if name not in ORACLES:
        return None if got_cols else "no columns"
    cur = con.execute(ORACLES[name])
    want_cols, want = normal([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got and not empty_ok:
        return "no rows on either side"
    for g, w in zip(got, want):
        if g != w or [kind(x) for x in g] != [kind(x) for x in w]:
            return f"{g} != {w}"
    return None


def main(argv):
    from quillrank.catalog import QUERIES
    from quillrank.session import local_session

    folder = argv[0]
    wanted = argv[1:] or list(QUERIES)
    spark = local_session(8)
    con = duck(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")


if __name__ == "__main__":
    main(sys.argv[1:])
