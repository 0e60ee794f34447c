"""Compare every registered query with its DuckDB oracle (driver-style gate).

    python scripts/check_oracles.py [sf_dir] [name ...]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracles import compare  # noqa: E402
from regloom.session import local_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session()
    bad = 0
    for o in compare(spark, sf_dir, names or None):
        tag = "OK  " if o.ok else "FAIL"
        extra = f" ({o.message})" if o.message else ""
        print(f"{tag} {o.name}: {o.rows} rows {o.seconds:.1f}s{extra}", flush=True)
        bad += not o.ok
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
