"""Write PLANS.md: the physical plan tree of every registered query.

    python tools/plans.py [sf_dir]

Uses ``explain("formatted")`` (operator tree part, expression ids removed) so
the plans can be reviewed and diffed between rounds.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settleframe.catalog import QUERIES  # noqa: E402
from settleframe.session import local_session  # noqa: E402


DETAIL = re.compile(r"^\(\d+\) (Scan|Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|WindowGroupLimit)")
KEEP = ("Arguments", "PushedFilters", "PartitionFilters", "ReadSchema", "Join type", "Left keys", "Right keys")


def tree(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    blocks = re.sub(r"#\d+L?", "", out.getvalue()).split("\n\n")
    lines = [blocks[0].strip(), ""]
    for block in blocks[1:]:
        rows = block.strip().splitlines()
        if rows and DETAIL.match(rows[0]):
            lines.append(rows[0])
            lines += [("  " + r)[:200] for r in rows[1:] if r.startswith(KEEP)]
    return "\n".join(lines).strip()


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    parts = ["# PLANS", "",
             f"Physical plans of the registered queries (`tools/plans.py`, {os.path.basename(sf_dir)}, "
             "AQE initial plan; AQE may still coalesce partitions or turn a sort-merge join into a "
             "broadcast at run time).", "",
             "`SinglePartition` exchanges appear only in one-row global aggregates and over one row "
             "per range part in `global_rank`.", ""]
    for name, build in QUERIES.items():
        parts += [f"## {name}", "", "```", tree(build(spark, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
