"""Run registered queries and their SQL side by side and compare the rows.

usage: python tools/verify.py [--dir DIR] [--only PREFIX[,PREFIX...]]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from murmura.session import local_session  # noqa: E402
from murmura.suite import CATALOG  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    fn, sql = CATALOG[name]
    start = time.time()
    df = fn(spark, folder)
    got = df.collect()
    took = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return False, "the plan joins without keys"
    if sql is None:
        return False, f"{len(got)} rows, no SQL to compare with"
    start = time.time()
    ref = con.execute(sql)
    columns = [c[0] for c in ref.description]
    want = ref.fetchall()
    sql_took = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(columns, want)
    if a != b:
        more, less = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"{len(got)} vs {len(want)} rows; only here {str(more)[:600]}; only SQL {str(less)[:600]}"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return True, f"{len(got)} rows, {took:.2f}s, SQL {sql_took:.2f}s, {types if not got else ''}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.dir)
    wanted = [p for p in args.only.split(",") if p]
    bad = 0
    for name in CATALOG:
        if wanted and not any(name.startswith(p) for p in wanted):
            continue
        try:
            ok, note = compare(spark, con, args.dir, name)
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:1200]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
