"""``python tests/check.py [sf] [name part ...]``: compare queries with their SQL."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeretrieve.registry import ORACLES, QUERIES  # noqa: E402
from lakeretrieve.session import build_session  # noqa: E402
from tests.oracle import compare, connection  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", 8)
    con = connection(sf_dir)
    bad = 0
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, sf_dir, name)
                kind = "sql "
            else:
                rows = QUERIES[name](spark, sf_dir).count()
                problem, kind = (None if rows else "no rows"), f"rows {rows}"
        except Exception as e:
            problem, kind = f"{type(e).__name__}: {str(e)[:600]}", "fail"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
