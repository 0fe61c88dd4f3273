"""Write PLANS.md: the physical operator tree of the main queries
(``explain("formatted")`` first section plus scan details) at sf0.1."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civiclens.plans import catalog  # noqa: E402
from civiclens.session import local_session  # noqa: E402

QUERIES = ["anti_join", "top20", "topk_per_group", "lookup_fill", "word_count",
           "freq_pairs", "freq_triples", "profile_counts", "profile_numeric",
           "semantic_labels", "semantic_targets", "fuzzy_column", "row_index"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans of the main queries", "",
           f"Generated by `scripts/plans_report.py` on `{sf}` (AQE initial plans; "
           "AQE may still turn shuffle joins into broadcasts from measured sizes).", ""]
    for name in QUERIES:
        text = formatted(catalog.QUERIES[name](spark, sf))
        tree = text.split("\n\n")[0]
        scans = sorted(set(re.findall(r"(ReadSchema: .*|PushedFilters: .*)", text)))
        out += [f"## {name}", "", "```", tree.strip(), *scans, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
