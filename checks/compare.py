"""Run registered queries beside their SQL twins and report differences: ``python -m checks.compare [sf_dir] [key…]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, sf_dir: str, key: str) -> str:
    """Empty when rows, columns and values agree, else the first difference."""
    df = QUERIES[key](spark, sf_dir)
    result = con.execute(ORACLES[key])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if diff:
        return f"{len(diff)} of {len(ours)} rows differ, first: {diff[0][0]} vs {diff[0][1]}"
    return ""


def main(argv):
    from meterloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in argv[1:] or QUERIES:
        start = time.perf_counter()
        try:
            if key in ORACLES:
                message = compare(spark, con, sf_dir, key)
                state = message or "ok"
            else:
                state, message = f"rows {len(QUERIES[key](spark, sf_dir).collect())}", ""
        except Exception as e:  # report and go on with the next key
            message = state = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {key:32s} {time.perf_counter() - start:6.2f}s  {state}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
