"""Run queries next to their SQL twins: ``python tools/check.py [sf_dir] [name or prefix* ...]``."""

from __future__ import annotations

import fnmatch
import logging
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str:
    note = ""
    rel = con.sql(sql)
    cols = sorted(df.columns)
    if cols != sorted(rel.columns):
        return f"columns {cols} != {sorted(rel.columns)}"
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    types = [(n, t, duck_types[n]) for n, t in df.dtypes if TYPE_NAMES.get(t, t.upper()) != duck_types[n] and not t.startswith("array")]
    note += f" TYPES {types}" if types else ""
    key = lambda row: tuple((v is None, str(v)) for v in row)
    start = time.time()
    rows = df.collect()
    note += f" (collect {time.time() - start:.2f}s)"
    mine = sorted((tuple(r[c] for c in cols) for r in rows), key=key)
    theirs = sorted((tuple(r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall()), key=key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}{note} only mine {[r for r in mine if r not in theirs][:2]} only sql {[r for r in theirs if r not in mine][:2]}"[:1500]
    for a, b in zip(mine, theirs):
        if a != b:
            return f"values {cols}\n   mine {a}\n   sql  {b}{note}"[:2500]
    return f"ok {len(mine)}{note}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from gleaner.catalog import ORACLES, QUERIES
    from gleaner.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    con = duck(sf_dir)
    failed = []
    for name, fn in QUERIES.items():
        if args and not any(fnmatch.fnmatch(name, a) for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            result = compare(df, con, ORACLES[name]) if name in ORACLES else f"ok rows-only {df.count()}"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:900]}"
        if not result.startswith("ok") or "TYPES" in result or result.startswith("ok 0"):
            failed.append(name)
        print(f"{name:28s} {time.time() - start:6.2f}s {result}", flush=True)
    print("to look at:", failed or "none")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
