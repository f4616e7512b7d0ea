"""Print the formatted physical plan of registered queries.

Usage: python tools/explain_plans.py [sf_dir] [query ...]

Queries that ingest or train run those steps while the frame is built; the
plan printed is the one of the returned DataFrame.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import build_session  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tidepool.plans import REGISTRY

    spark = build_session("local[4]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or list(REGISTRY):
        print(f"===== {name} ({', '.join(REGISTRY[name].ids)})")
        REGISTRY[name].fn(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
