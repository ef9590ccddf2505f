"""Compare queries with their SQL: python tests/check.py [name-part ...] [--sf DIR]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry
from larder.sources.staging import release

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0 if v else 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def compare(spark, con, name, sf):
    t0 = time.time()
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(x) for x in row) for row in df.select(*cols).collect())
    release(spark)
    t1 = time.time() - t0
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return name, "rows-only", len(got), t1, ""
    rel = con.sql(sql)
    ocols = sorted(rel.columns)
    if ocols != cols:
        return name, "COLUMNS", len(got), t1, f"only spark {set(cols) - set(ocols)}, only sql {set(ocols) - set(cols)}"
    want = sorted(tuple(norm(x) for x in row) for row in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    types = dict(zip(rel.columns, [str(x) for x in rel.types]))
    note = " ".join(
        f"{c}:{t}/{types[c]}" for c, t in df.dtypes if family(t) != family(types[c].lower())
    )
    if got == want:
        return name, "ok" if got else "EMPTY", len(got), t1, note
    ga, wa = set(got) - set(want), set(want) - set(got)
    return name, "DIFF", len(got), t1, f"{len(got)} vs {len(want)} rows\n   cols {cols}\n   spark {sorted(ga)[:2]}\n   sql   {sorted(wa)[:2]} {note}"


def family(t: str) -> str:
    t = t.lower()
    for f, words in {
        "int": ("int", "hugeint"),
        "double": ("double", "float"),
        "decimal": ("decimal",),
        "string": ("string", "varchar"),
        "timestamp": ("timestamp",),
        "date": ("date",),
        "boolean": ("boolean",),
    }.items():
        if any(t.startswith(w) or (f == "int" and t.endswith("int")) for w in words):
            return f
    return t


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        args = args[:i] + args[i + 2 :]
    from tests.conftest import make_session

    spark = make_session()
    con = connect(sf)
    names = [n for n in entry.queries() if not args or any(a in n for a in args)]
    bad = 0
    for n in names:
        try:
            res = compare(spark, con, n, sf)
        except Exception as e:  # report and go on with the other queries
            res = (n, "ERROR", 0, 0.0, f"{type(e).__name__}: {str(e)[:900]}")
        if res[1] not in ("ok", "rows-only"):
            bad += 1
        print(f"{res[1]:9} {res[0]:40} rows={res[2]:<7} {res[3]:5.1f}s {res[4]}", flush=True)
    print(f"{len(names)} queries, {bad} to look at")


if __name__ == "__main__":
    main()
