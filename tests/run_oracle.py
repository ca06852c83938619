"""Dev helper: run registered queries against their SQL twins.

usage: python tests/run_oracle.py [sf_dir] [name-substring ...]
"""
import sys, time
sys.path.insert(0, "."); sys.path.insert(0, "tests")
from relaywatch.session import get_session
from relaywatch.plans import QUERIES, ORACLE
from compare import compare, duck

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
pats = sys.argv[2:]
spark = get_session("local[8]", shuffle_partitions=8)
con = duck(sf)
bad = 0
for name, fn in QUERIES.items():
    if pats and not any(p in name for p in pats):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in ORACLE:
            n = compare(df, ORACLE[name], sf, con)
            print(f"OK   {name:32s} rows={n:7d} {time.time()-t:6.2f}s")
        else:
            n = df.count()
            print(f"ROWS {name:32s} rows={n:7d} {time.time()-t:6.2f}s")
    except Exception as e:
        bad += 1
        print(f"FAIL {name:32s} {type(e).__name__}: {str(e)[:1500]}")
print("failures:", bad)
