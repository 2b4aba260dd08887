"""Print the formatted physical plan of catalog queries.

usage: python scripts/explain_plans.py [sf_dir] [name ...]
Iterative graph queries show the plan of their last round (earlier rounds
are read back from checkpoints).
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
from kestrel.plans.catalog import QUERIES  # noqa: E402
from kestrel.session import tuned_builder  # noqa: E402

DEFAULT = ["missing_counts", "modes", "hash_split", "oversample", "weighted_metrics", "triangles"]


def main():
    args = sys.argv[1:]
    base = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or DEFAULT
    spark = tuned_builder().getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, base).explain("formatted")


if __name__ == "__main__":
    main()
