"""Run queries against their DuckDB oracles: python tests/run_oracles.py [sf_dir] [name ...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridloom.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = local_session(8)
con = duck(sf)
qs, os_ = E.queries(), E.oracle_sql()
fails = 0
for n in names or sorted(qs):
    t = time.time()
    try:
        df = qs[n](spark, sf)
        if n in os_:
            ok, msg = compare(df, con, os_[n])
        else:
            ok, msg = True, f"rows only: {df.count()}"
    except Exception as ex:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(ex).__name__}: {str(ex)[:600]}"
    fails += not ok
    print(f"{'PASS' if ok else 'FAIL'} {n:28s} {time.time() - t:6.1f}s {msg}", flush=True)
print("failures:", fails)
