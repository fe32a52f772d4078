"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v).lower()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from aurum.session import local_session
    from aurum.plans.catalog import full_sql, load_all

    spark = local_session()
    reg = load_all()
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    ok = bad = rows_only = 0
    for name, e in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = e.build(spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if e.sql is None:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s)")
            rows_only += 1
            continue
        try:
            res = con.execute(full_sql(e.sql))
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:600]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns spark={sorted(cols)} oracle={sorted(ocols)}")
            bad += 1
            continue
        hs, ls = digest(cols, srows)
        ho, lo = digest(ocols, orows)
        if hs == ho:
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
            ok += 1
        else:
            print(f"FAIL {name}: rows spark={len(srows)} oracle={len(orows)}")
            so, oo = set(ls), set(lo)
            for x in sorted(so - oo)[:3]:
                print("   spark-only :", x[:300])
            for x in sorted(oo - so)[:3]:
                print("   oracle-only:", x[:300])
            bad += 1
    print(f"summary ok={ok} fail={bad} rows_only={rows_only}")
    spark.stop()


if __name__ == "__main__":
    main()
