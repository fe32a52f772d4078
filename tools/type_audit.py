"""Compare column type families of every query (Spark) with its oracle (DuckDB) on sf0.001."""
import sys
ROOT = __import__("pathlib").Path(__file__).resolve().parents[1]; sys.path.insert(0, str(ROOT)); sys.path.insert(0, str(ROOT / "tools"))
import duckdb
from pathlib import Path
from check import TABLES
from aurum.session import local_session
from aurum.plans.catalog import full_sql, load_all
spark = local_session()
sf = "/root/testdata/sf0.001"
con = duckdb.connect()
for t in TABLES:
    p = Path(sf) / f"{t}.parquet"
    if p.exists(): con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
def fam_s(t):
    t = t.lower()
    if t in ("tinyint","smallint","int","bigint"): return "int:" + t
    if t in ("float","double"): return "float"
    if t.startswith("decimal"): return "decimal"
    if t == "string": return "string"
    if t.startswith("array"): return "array"
    if t.startswith("timestamp"): return "ts"
    return t
def fam_d(t):
    t = str(t).upper()
    m = {"TINYINT":"int:tinyint","SMALLINT":"int:smallint","INTEGER":"int:int","BIGINT":"int:bigint","HUGEINT":"int:hugeint",
         "FLOAT":"float","DOUBLE":"float","VARCHAR":"string","DATE":"date","BOOLEAN":"boolean"}
    if t in m: return m[t]
    if t.startswith("DECIMAL"): return "decimal"
    if t.endswith("[]"): return "array"
    if t.startswith("TIMESTAMP"): return "ts"
    return t
for name, e in load_all().items():
    if not e.sql: continue
    df = e.build(spark, sf)
    s = {f.name: fam_s(f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(full_sql(e.sql))
    d = {c: fam_d(t) for c, t in zip(rel.columns, rel.types)}
    diff = {c: (s[c], d.get(c)) for c in s if s[c] != d.get(c)}
    if diff: print(name, diff)
