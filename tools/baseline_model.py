"""Time the literal sequential algorithm (tests/model.py) on the fixture.

It is the matched job's own loop in one Python process (nested scans per
round, float scores), with the hash encoder standing in for the model, so
it is a lower bound on the sequential job's cost.  Usage:
python tools/baseline_model.py sf_dir mode policy
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import model  # noqa: E402
from skulink.session import get_spark  # noqa: E402
from skulink.sources import fixture as fx  # noqa: E402


def main():
    sf, mode, policy = sys.argv[1], sys.argv[2], sys.argv[3]
    spark = get_spark("local[2]", shuffle_partitions=2)
    left = [r.asDict() for r in fx.fixture_left(spark, sf).collect()]
    right = [r.asDict() for r in fx.fixture_right(spark, sf).collect()]
    spark.stop()
    t = time.perf_counter()
    out = model.run(left, right, mode=mode, policy=policy)
    print(json.dumps({"sf": sf, "mode": mode, "policy": policy, "left": len(left),
                      "right": len(right), "matched": len(out),
                      "seconds": round(time.perf_counter() - t, 2)}))


if __name__ == "__main__":
    main()
