"""Run registered queries in Spark and their SQL in DuckDB on the same Parquet files."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """Differences as text, or None if schema names, types and rows agree."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]).lower() for d in rel.description}
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    alias = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}
    mine = {f.name: alias.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (mine[c], types[c]) for c in mine if mine[c] != types[c]}
    if got != want:
        return f"rows {sum(got.values())} vs {sum(want.values())}; only spark {list((got - want).items())[:2]}; only sql {list((want - got).items())[:2]}"
    if wrong:
        return f"types (spark, sql) {wrong}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from ledgerline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", {"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf), e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            diff = compare(spark, con, name, fn, oracle[name], sf) if name in oracle else "no SQL"
        except Exception as ex:  # noqa: BLE001 - report and go on
            diff = f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += diff not in (None, "no SQL")
        print(f"{'ok  ' if diff is None else 'none' if diff == 'no SQL' else 'FAIL'} {name} {time.time() - t:.2f}s {diff or ''}", flush=True)
    print("failures:", bad)
