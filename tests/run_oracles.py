"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")
from oracle_harness import compare, duck  # noqa: E402
from riskspark.session import get_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = get_session()
con = duck(sf)
qs, os_ = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in os_:
            ok, msg = compare(df, con, os_[name])
        else:
            ok, msg = True, f"rows-only: {df.count()} rows"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s {msg}", flush=True)
print("mismatches:", bad)
