"""Compare queries with their SQL twins: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from vialume.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        if isinstance(v, dict):
            return repr(sorted(v.items()))
        if isinstance(v, (list, tuple)):
            return repr([value(x) for x in v])
        return repr(v) if not isinstance(v, bool) else repr(bool(v))

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got = [tuple(r.asDict(recursive=True).values()) for r in df.collect()]
    took = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return True, f"rows only, {len(got)} rows, {took:.1f} s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if a != b:
        only_a = [x for x in a if x not in set(b)][:3]
        only_b = [x for x in b if x not in set(a)][:3]
        return False, f"{len(a)} rows against {len(b)}; spark only {only_a}; sql only {only_b}"
    return True, f"{len(a)} rows, {took:.1f} s"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(contract.queries())
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(("ok   " if ok else "FAIL ") + f"{name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
