"""Print the formatted physical plan of registered queries.

usage: python tools/show_plans.py [sf_dir] key [key ...]
Used to check that scans are pruned (ReadSchema), filters pushed
(PushedFilters), aggregates partial, and joins broadcast only when sized.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from claimspark.plans.registry import QUERIES
    from claimspark.session import build_session

    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    for k in keys:
        print(f"===== {k} =====")
        QUERIES[k](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
