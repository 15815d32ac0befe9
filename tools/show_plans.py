"""Print the physical plans of the headline queries (operators only, long literals cut).

    python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans import scenarios  # noqa: E402
from quarry.session import get_session  # noqa: E402

DEFAULT = ["prepare_books", "knn_all", "bm25_topk", "hybrid_rrf", "fulltext_get", "compare_overlap", "collection_clustered_filter", "bm25_indexed"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_session()
    for name in names:
        df = scenarios.REGISTRY[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n```")
        for i, line in enumerate(plan.splitlines()):
            if i and "+- " not in line:
                continue  # continuation of a long expression
            m = re.match(r"^([\s:|+\-]*)(\*\(\d+\) )?(.*)$", line)
            prefix, body = m.group(1), m.group(3)
            head = re.split(r" \[|\(|,", body, maxsplit=1)[0]
            print((prefix + head.rstrip())[:200])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        scans = [ln.strip() for ln in buf.getvalue().splitlines()
                 if ln.startswith(("PushedFilters:", "PartitionFilters:", "ReadSchema:")) and "[]" not in ln]
        for ln in scans:
            print("  " + re.sub(r"INSET [^)\]]*", "INSET ...", ln)[:200])
        print("```\n")


if __name__ == "__main__":
    main()
