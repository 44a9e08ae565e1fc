"""Run every registered query against its oracle: python tests/check_all.py [sf_dir] [names...]"""

import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from rxlake.session import get_spark  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(E.queries())
spark = get_spark(master="local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
oracles = E.oracle_sql()
bad = 0
for n in names:
    t0 = time.time()
    try:
        df = E.queries()[n](spark, sf)
        if n in oracles:
            ok, msg = compare(df, con, oracles[n])
        else:
            cnt = df.count()
            ok, msg = True, f"{cnt} rows (no oracle)"
    except Exception as ex:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(ex).__name__}: {str(ex)[:800]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:40s} {time.time()-t0:6.1f}s  {msg}", flush=True)
print(f"{bad} failing of {len(names)}")
