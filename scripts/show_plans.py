"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]   (default: the bench headline queries)
Look for WindowGroupLimit on both sides of the top-k shuffle, BroadcastHashJoin on the query
side, pruned ReadSchema on postings and PartitionFilters on a saved, bucketed index.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from bench import HEADLINE
    from sparkqa.plans.queries import QUERIES
    from sparkqa.session import get_spark, ship_package
    spark = get_spark("local[8]", 8)
    ship_package(spark)
    for name in sys.argv[2:] or HEADLINE:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
