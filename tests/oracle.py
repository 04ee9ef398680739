"""Runs registered queries against their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Spark type name -> DuckDB type names that hold the same values.
TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "double": {"DOUBLE"}, "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark frame and a DuckDB query; empty when equal."""
    problems = []
    names = sorted(df.columns)
    con.execute(f"CREATE OR REPLACE TEMP TABLE _oracle AS {sql}")
    kinds = {r[0]: r[1] for r in con.execute("DESCRIBE _oracle").fetchall()}
    if names != sorted(kinds):
        return [f"columns {names} vs {sorted(kinds)}"]
    for name, kind in df.dtypes:
        if kinds[name] not in TYPES.get(kind, set()):
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    ours = sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=key)
    quoted = ", ".join('"' + n + '"' for n in names)
    theirs = sorted((tuple(_cell(v) for v in r) for r in con.execute(f"SELECT {quoted} FROM _oracle").fetchall()), key=key)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        problems.append(f"{len(wrong)} rows differ, first: {str(dict(list(diff.items())[:4]))[:600]} in {str(a)[:200]}")
    if not ours:
        problems.append("no rows")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from faultline.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv and not any(a in name for a in argv):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        mark = "ok  " if not problems else "FAIL"
        print(mark, name, "" if name in oracles else "(rows only)", f"{time.time() - start:.2f}s", *problems, flush=True)
        bad += bool(problems)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
