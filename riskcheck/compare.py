"""Run a registered query on Spark and its SQL twin on DuckDB and compare."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from riskcheck import ORACLES, QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([repr(t[i]) for i in order] for t in tuples))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    columns, tuples = df.columns, [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return len(tuples) > 0, f"rows only, {len(tuples)} rows, {took:.1f}s"
    start = time.time()
    cur = con.execute(ORACLES[name])
    expected_columns, expected = [d[0] for d in cur.description], cur.fetchall()
    note = f"{len(tuples)} rows, {took:.1f}s, sql {time.time() - start:.1f}s"
    if sorted(columns) != sorted(expected_columns):
        return False, f"columns {sorted(columns)} vs {sorted(expected_columns)}"
    types = {c: t for c, t in zip(columns, [t for _, t in df.dtypes])}
    sql_types = {d[0]: str(d[1]).lower() for d in cur.description}
    same = {"integer": "int", "varchar": "string"}
    odd = {c: (types[c], sql_types[c]) for c in columns
           if same.get(sql_types[c], sql_types[c]) != types[c] and "timestamp" not in types[c]}
    got, want = _rows(columns, tuples), _rows(expected_columns, expected)
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w][:3]
        return False, f"{note}; {len(got)} vs {len(want)} rows, first differences {diff}"
    return not odd, f"{note}{'; types ' + str(odd) if odd else ''}"


def main(sf_dir: str, names: list[str]) -> int:
    from riskcheck.session import local_session
    spark = local_session("compare")
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(QUERIES):
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} of {len(names or QUERIES)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
