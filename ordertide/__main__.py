"""Run the pipeline and show registered queries.

    python -m ordertide [SF_DIR] [QUERY ...]

Without query names it shows the three business questions and the quality
gate.  ``python -m ordertide --list`` prints the registered query names.
Uses ``local[$ORDERTIDE_CPUS]`` (default 8) when no session is active.
"""

from __future__ import annotations

import os
import sys

DEFAULT_QUERIES = ["orders_by_state", "price_stats", "top_rep_by_profit", "dq_stage_rollup", "dq_final_gate"]


def main(argv: list[str]) -> int:
    from ordertide.plans.catalogue import QUERIES

    if argv and argv[0] == "--list":
        print("\n".join(sorted(QUERIES)))
        return 0
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or DEFAULT_QUERIES
    unknown = [n for n in names if n not in QUERIES]
    if unknown:
        print(f"unknown queries: {unknown}; see --list", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from ordertide.session import local_session

    spark = SparkSession.getActiveSession() or local_session(cores=int(os.environ.get("ORDERTIDE_CPUS", "8")))
    for name in names:
        print(f"== {name}")
        QUERIES[name](spark, sf_dir).show(25, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
