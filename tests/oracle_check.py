"""Run registered queries against their SQL in DuckDB.

usage: python tests/oracle_check.py [--sf 0.001] [name substring ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


SPARK_DONE = [0.0]


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, repr(v + 0.0))
    return (1, str(v))


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    return {int: "int", float: "float", str: "str"}.get(type(v), type(v).__name__)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else the difference."""
    cols = sorted(spark_df.columns)
    if len(set(cols)) != len(cols):
        return "duplicate column names"
    mine = [tuple(r) for r in spark_df.select(*cols).collect()]
    SPARK_DONE[0] = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns differ: only spark {sorted(set(cols) - set(names))}, only sql {sorted(set(names) - set(cols))}"
    order = [names.index(c) for c in cols]
    theirs = [tuple(r[i] for i in order) for r in cur.fetchall()]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    for i, c in enumerate(cols):
        a = {_kind(r[i]) for r in mine if r[i] is not None}
        b = {_kind(r[i]) for r in theirs if r[i] is not None}
        if a != b:
            return f"type of {c}: {a} vs {b}"
    a = sorted(tuple(_cell(v) for v in r) for r in mine)
    b = sorted(tuple(_cell(v) for v in r) for r in theirs)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        x, y = bad[0]
        diff = [(c, p[1], q[1]) for c, p, q in zip(cols, x, y) if p != q]
        return f"{len(bad)} rows differ of {len(a)}; first {diff[:4]} in {[p[1] for p in x][:8]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from refiscope.catalog.registry import MODULE_OF
    from refiscope.session import local_session

    args = sys.argv[1:]
    sf = "0.001"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failures = 0
    for name, fn in entry.queries().items():
        if args and not any(a in name or a == MODULE_OF.get(name) for a in args):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                rows = "" if problem else df.columns.__len__()
                status = "ok" if problem is None else f"DIFF {problem}"
            else:
                status = f"rows-only {df.count()}"
        except Exception as e:  # noqa: BLE001
            status = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        if status.startswith(("DIFF", "ERROR")):
            failures += 1
        spark_s = max(SPARK_DONE[0] - t0, 0.0)
        print(f"{time.time() - t0:6.1f}s (spark {spark_s:.1f}) {name}: {status}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main())
