"""CLI: compare registered queries against their DuckDB oracles.

    python tests/run_oracle.py [sf_dir] [name ...]
"""
import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit.session import build_session  # noqa: E402
from cohortkit.plans.registry import load_all  # noqa: E402
from oracle import duck, compare  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    qs, orc = load_all()
    names = args or list(qs)
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            if n in orc:
                rows, probs = compare(spark, con, qs[n], orc[n], sf_dir)
            else:
                rows, probs = qs[n](spark, sf_dir).count(), ["(no oracle)"]
        except Exception as e:  # noqa: BLE001
            rows, probs = -1, [f"ERROR {type(e).__name__}: {str(e)[:400]}"]
        ok = not probs or probs == ["(no oracle)"]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} rows={rows:<7} {time.time()-t:5.1f}s {' | '.join(probs)}", flush=True)
    print(f"{len(names)-bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
