"""Runs registered queries against their SQL on one scale and reports differences.

    python -m checks.compare [--sf DIR] [names…]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from checks.queries import QUERIES, SQL
from vitrine.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        return f"{float(value):.6f}"
    if isinstance(value, int):
        return str(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(_cell(row[n]) for n in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, str]:
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    spark_seconds = time.time() - started
    if name not in SQL:
        return ("rows", f"{len(mine)} rows {spark_seconds:.1f}s")
    started = time.time()
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    sql_seconds = time.time() - started
    note = f"{len(mine)} rows, spark {spark_seconds:.1f}s, sql {sql_seconds:.1f}s"
    if sorted(df.columns) != sorted(columns):
        return ("COLUMNS", f"{sorted(df.columns)} vs {sorted(columns)}")
    if not mine:
        return ("EMPTY", note)
    if mine == theirs:
        return ("ok", note)
    extra = sorted(set(mine) - set(theirs))
    missing = sorted(set(theirs) - set(mine))
    shown = "\n   spark only: ".join([""] + [str(r)[:700] for r in extra[:3]]) + "\n   sql only:   ".join([""] + [str(r)[:700] for r in missing[:3]])
    return ("DIFF", f"{note}; {len(theirs)} sql rows; {len(extra)} only in spark, {len(missing)} only in sql {shown}")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session("8"), connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        try:
            status, note = compare(spark, con, name, args.sf)
        except Exception as error:  # keep going: the report lists every failure
            status, note = "ERROR", f"{type(error).__name__}: {str(error)[:1500]}"
        bad += status not in ("ok", "rows")
        print(f"{status:8s} {name}: {note}", flush=True)
    print(f"{bad} not matching")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
