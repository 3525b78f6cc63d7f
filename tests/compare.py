"""Run named queries against their SQL twins: ``python tests/compare.py [sf] [prefix ...]``."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for types, name in (((int,), "int"), ((Decimal,), "decimal"), ((float,), "double"), ((str,), "text"), ((dt.datetime,), "ts"), ((dt.date,), "date")):
        if isinstance(value, types):
            return name
    return type(value).__name__


def table(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((kind(r[i]) if r[i] is not None else "null", str(r[i])) for i in order) for r in rows)


def differences(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count, and no problems when names, types, row counts and every value agree."""
    got = df.collect()
    result = con.execute(sql)
    names, want = [d[0] for d in result.description], result.fetchall()
    if sorted(df.columns) != sorted(names):
        return len(got), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    left, right = table([tuple(r) for r in got], df.columns), table(want, names)
    problems = []
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if left != right:
        problems.append(f"only spark: {list((left - right).items())[:2]}")
        problems.append(f"only sql:   {list((right - left).items())[:2]}")
    return len(got), problems


def main() -> None:
    from trueledger import registry
    from trueledger.session import get_session

    sf, *prefixes = sys.argv[1:] or ["0.01"]
    sf_dir = f"{DATA}/sf{sf}"
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    bad = 0
    for name, fn in registry.QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            if name in registry.ORACLES:
                n, problems = differences(fn(spark, sf_dir), duck(sf_dir), registry.ORACLES[name])
            else:
                n, problems = len(fn(spark, sf_dir).collect()), []
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
            n = "-"
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name:32s} {time.time() - start:6.2f}s {n:>7} rows{'' if name in registry.ORACLES else ' (no sql)'}", flush=True)
        for p in problems:
            print("      ", p)
    print("differing:", bad)


if __name__ == "__main__":
    main()
