"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2",
               BENCH_QUERIES="count_by_key,top20", BENCH_WARM_DIR=SF_SMALL)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"count_by_key", "top20"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or abs(
        rec["value"] - sum(rec["queries"].values())) < 1e-6
