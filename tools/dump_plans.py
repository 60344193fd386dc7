"""Write the physical plan of every registered query to PLANS.md.

Usage: python -m tools.dump_plans [sf_dir]

Sink and stream queries run their writes while the plan is built (the plan
shown is the read of what they wrote); the jobs show the read of the staged
table with the one statistics subquery.
"""

from __future__ import annotations

import re
import sys

MAX_LINE = 180


def main(argv):
    sys.path.insert(0, ".")
    from sluice.plans.catalog import BATCH_ID, QUERIES
    from sluice.plans.inspect import plan_text
    from sluice.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]", shuffle_partitions=4)
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python -m tools.dump_plans` on `{sf_dir}` (Spark {spark.version}, AQE on; ",
        "plans before execution, expression ids removed, long lines cut).",
        "",
    ]
    from sluice.plans.admissions import admissions_prepared
    from sluice.plans.smart_home import smart_home_prepared
    from sluice.sources.fixtures import admissions_raw, smart_home_raw

    frames = {name: fn for name, fn in sorted(QUERIES.items())}
    # what the two jobs write to their stage (the plans above show the read)
    frames["admissions_etl: stage written"] = lambda s, d: admissions_prepared(
        admissions_raw(s, d), BATCH_ID
    )
    frames["smart_home_etl: stage written"] = lambda s, d: smart_home_prepared(
        smart_home_raw(s, d), BATCH_ID
    )
    for name, fn in frames.items():
        text = plan_text(fn(spark, sf_dir), "simple")
        text = re.sub(r"#\d+L?", "", text)
        text = re.sub(r", \[plan_id=\d+\]|, \[id=#?\d*\]", "", text)
        lines = [line if len(line) <= MAX_LINE else line[: MAX_LINE - 3] + "..." for line in text.splitlines()]
        lines = [line for line in lines if line.strip() and not line.startswith("== Physical Plan")]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
