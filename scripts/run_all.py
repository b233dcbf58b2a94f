"""Run every registered query once and print rows and schema (smoke run)."""
import sys, time
sys.path.insert(0, ".")
from stockflow.session import build_session
from stockflow.plans.registry import QUERIES

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
only = sys.argv[2:] or list(QUERIES)
spark = build_session("local[8]", 8)
for name in only:
    t = time.time()
    try:
        df = QUERIES[name](spark, sf)
        n = df.count()
        print(f"{name:34s} rows={n:8d} {time.time()-t:6.2f}s {df.dtypes}")
    except Exception as e:
        print(f"{name:34s} ERROR {type(e).__name__}: {str(e)[:300]}")
