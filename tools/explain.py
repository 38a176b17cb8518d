"""Print the physical plan of registered queries.

Usage: python tools/explain.py [--run] [--dir DATA_DIR] name [name ...]
With --run the query is executed first, so the final adaptive plan is shown.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from kpiwatch.plans.queries import queries
    from kpiwatch.session import local_session

    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="+")
    p.add_argument("--dir", default="/root/testdata/sf0.01")
    p.add_argument("--run", action="store_true")
    a = p.parse_args()
    spark = local_session()
    registered = queries()
    for name in a.names:
        df = registered[name](spark, a.dir)
        if a.run:
            df.collect()
        print(f"### {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
