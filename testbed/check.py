"""Side-by-side check of registered queries: ``python -m testbed.check [sf] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from milepost.session import spark_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return "nan" if value != value else value
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def compare(got, want) -> str:
    """'' when both results hold the same rows; otherwise what differs."""
    gc, wc = sorted(got[0]), sorted(want[0])
    if gc != wc:
        return f"columns differ: only spark {set(gc) - set(wc)}, only sql {set(wc) - set(gc)}"

    def rows(result):
        names, data = result
        order = [names.index(c) for c in gc]
        out = [tuple(_norm(r[i]) for i in order) for r in data]
        return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))

    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"row counts differ: {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            bad = [(c, u, v) for c, u, v in zip(gc, x, y) if u != v or type(u) is not type(v)]
            return f"first difference: {bad} in row {x}"
    return ""


def run(name: str, spark, con, sf_dir: str) -> str:
    from testbed.catalog import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = (df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if got[1] else "no rows"
    result = con.execute(ORACLES[name])
    want = ([d[0] for d in result.description], result.fetchall())
    return compare(got, want)


def main(argv: list[str]) -> int:
    from testbed.catalog import QUERIES

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = argv[1:] or list(QUERIES)
    spark = spark_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = run(name, spark, con, sf_dir)
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:6.2f}s {name} {problem[:900]}",
              flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
