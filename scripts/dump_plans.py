"""Write PLANS.md: the physical plans (before AQE re-planning) of the headline
queries at sf0.01, as Spark prints them with ``explain()``.

    python scripts/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from docrank.plans import catalog as C  # noqa: E402
from docrank.plans.inspect import plan_string  # noqa: E402
from docrank.session import local_session  # noqa: E402

NAMES = ["word_count_lower", "tfidf_sql", "search_sum_top5",
         "index_search_sum", "posting_list"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}` "
          "(local[8]; the initial plan, before AQE re-plans with runtime sizes).\n")
    print("The exchange by a hash of the row under a corpus scan is the input balancing: the test "
          "table is one file for 8 cores. A corpus of many files is read without it.\n")
    for name in NAMES:
        df = C.QUERIES[name](spark, sf_dir)
        text = plan_string(df, "simple")
        # drop scratch paths and long lambda bodies for readability
        lines = [ln if len(ln) < 240 else ln[:237] + "..." for ln in text.splitlines()]
        print(f"## {name}\n\n```")
        print("\n".join(lines).replace(HERE, "<repo>"))
        print("```\n")


if __name__ == "__main__":
    main()
