"""Run the registered queries against their SQL check: ``python -m grainline.plans.check [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    """A value in a form both engines agree on."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal, int)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6) + 0.0
    return str(value)


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, folder, name, run, sql, db):
    started = time.time()
    df = run(spark, folder)
    got = df.collect()
    took = time.time() - started
    if sql is None:
        return f"rows={len(got)} (no check)", took, True
    cursor = db.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want_types = [str(d[1]) for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns differ: {sorted(df.columns)} / {sorted(want_names)}", took, False
    a, b = rows_of(df.columns, got), rows_of(want_names, want)
    types = dict(zip(want_names, want_types))
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    odd = [f"{n}:{t}/{types[n]}" for n, t in df.dtypes if same.get(t) != types[n]]
    note = f" types {odd}" if odd else ""
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"VALUES DIFFER rows {len(a)}/{len(b)} {diff}{note}", took, False
    return f"ok rows={len(a)}{note}", took, True


def main(argv):
    import duckdb

    from grainline.plans import CHECKS, QUERIES
    from grainline.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            text, took, ok = compare(spark, folder, name, QUERIES[name], CHECKS.get(name), db)
        except Exception as problem:  # noqa: BLE001
            text, took, ok = f"ERROR {type(problem).__name__}: {str(problem)[:700]}", 0.0, False
        bad += not ok
        print(f"{'  ' if ok else '!!'} {name:32s} {took:6.2f}s {text}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
