"""Run registered queries in Spark and their oracle SQL in DuckDB; report matches."""
import sys, time
sys.path.insert(0, "."); sys.path.insert(0, "tests")
from oracle_compare import compare, duckdb_for
from stockflow.session import build_session
from stockflow.plans.registry import QUERIES
from stockflow.plans.oracle import ORACLE_SQL

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:] or list(QUERIES)
spark = build_session("local[8]", 8)
con = duckdb_for(sf)
bad = 0
for name in only:
    t = time.time()
    if name not in ORACLE_SQL:
        print(f"{name:34s} (no oracle)"); continue
    try:
        ok, msg = compare(QUERIES[name](spark, sf), ORACLE_SQL[name], con)
    except Exception as e:
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{name:34s} {'OK ' if ok else 'BAD'} {time.time()-t:6.2f}s {msg}")
print("mismatches:", bad)
