"""Print the formatted physical plan of registered queries, with counts of
exchanges, broadcasts, reused exchanges and window operators.

    python tools/explain_query.py sf_dir query [query ...]
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf, names = argv[1], argv[2:]
    from clickforge.plans.queries import QUERIES
    from clickforge.session import build_session
    spark = build_session()
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        print(f"== {name}: exchanges {sum(bool(re.search(r'[+]- Exchange ', l)) for l in lines)}, "
              f"broadcasts {sum('BroadcastExchange' in l for l in lines)}, "
              f"reused {sum('ReusedExchange' in l for l in lines)}, "
              f"windows {sum(' Window ' in l for l in lines)}")
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
