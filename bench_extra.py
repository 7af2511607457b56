"""

1. speed-up of ``seasonality_factors`` and ``quote_chain`` on 1 vs 4 cores
   (separate JVMs via bench.py);
2. the built-in, the split and the approximate grouped median on the
   seasonal rows at sf0.1.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def cores(sf_dir: str, cpus: int, names: list[str]) -> dict:
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS=str(cpus), BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), *names], env=env,
                         capture_output=True, text=True, timeout=3600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")][-1]
    return json.loads(line)["queries"]


def median_modes(sf_dir: str) -> dict:
    from pyspark.sql import functions as F
    from pricewise.operators.median import grouped_median
    from pricewise.plans.context import Chain
    from pricewise.session import get_session
    scratch = tempfile.mkdtemp(prefix="bench-extra-", dir="/tmp")
    spark = get_session("local[8]", extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    rows = Chain(spark, sf_dir).rows
    rows.count()
    res = {}
    keys = ["body", "sale_month"]
    built_in = rows.groupBy(*keys).agg(F.median("price_ratio").alias("median"))
    for name, frame in (("built_in", built_in), ("split", grouped_median(rows, keys, "price_ratio")),
                        ("approximate", grouped_median(rows, keys, "price_ratio", accuracy=10_000))):
        ts = []
        for _ in range(3):
            t0 = time.perf_counter()
            frame.write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        res[name] = round(statistics.median(ts), 3)
    spark.stop()
    return res


if __name__ == "__main__":
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = ["seasonality_factors", "quote_chain"]
    one, four = cores(sf, 1, names), cores(sf, 4, names)
    out = {"sf": sf, "cores_1": one, "cores_4": four,
           "speedup_4_vs_1": {k: round(one[k] / four[k], 2) for k in names if k in one and k in four},
           "median_seconds": median_modes(sf)}
    print(json.dumps(out))
