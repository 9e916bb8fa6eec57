"""Write PLANS.md: the physical plan of every registered batch query.

    python tools/explain_all.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.plans.catalog import QUERIES  # noqa: E402
from tributary.session import get_session  # noqa: E402

WIDTH = 160


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "",
           f"`explain()` of every registered batch query on `{sf_dir}` (initial adaptive plan; AQE may",
           "still turn a shuffle join into a broadcast or coalesce partitions at run time). Lines are",
           f"cut at {WIDTH} characters. Regenerate with `python tools/explain_all.py`.", ""]
    for name, fn in QUERIES.items():
        if name.startswith("t"):
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        lines = [ln if len(ln) <= WIDTH else ln[:WIDTH] + " ..." for ln in buf.getvalue().rstrip().splitlines()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
