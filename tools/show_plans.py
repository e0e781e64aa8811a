"""Print the final (post-AQE) physical plan of registered queries.

    python tools/show_plans.py [sf_dir] [query ...]

Each query is executed once (collect) so the adaptive plan is final; long
expressions are shortened to keep the operator tree readable.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = [
    "q_loyal_customers",
    "q_purchase_report_category",
    "q_validate_transactions",
    "q_error_report",
    "q_load_order_details",
    "q_audit_log",
]


def condensed(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Batched: .*?(PushedFilters: \[[^\]]*\]?).*?(ReadSchema: \S+)", r"\1, \2", line)
        out.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(out)


def main(argv: list[str]) -> None:
    from handover.plans.queries import QUERIES
    from handover.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or HEADLINE
    spark = local_session(8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        print(f"### {name}\n\n```\n{condensed(final)}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
