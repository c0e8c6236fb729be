"""Print the formatted physical plan of registered queries.

    python -m svcvitals.plans.explain [--sf-dir DIR] query [query ...]

Shows pushed filters / read schemas of the scans, exchanges and join strategies.
"""

from __future__ import annotations

import argparse

from svcvitals.plans.queries import QUERIES
from svcvitals.session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="svcvitals.plans.explain")
    ap.add_argument("queries", nargs="+", choices=sorted(QUERIES))
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted", choices=["simple", "extended", "cost", "formatted"])
    a = ap.parse_args(argv)
    spark = build_session("local[*]")
    for name in a.queries:
        print(f"===== {name}")
        QUERIES[name](spark, a.sf_dir).explain(a.mode)
    spark.stop()


if __name__ == "__main__":
    main()
