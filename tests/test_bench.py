"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "label_counts",
                          "itemsets_pairs"], capture_output=True, text=True, env=env,
                         timeout=600, check=True)
    line = [ln for ln in out.stdout.splitlines() if ln.strip()][-1]
    data = json.loads(line)
    assert data["unit"] == "sec" and data["sf"] == 0.001 and "errors" not in data
    assert set(data["queries"]) == {"label_counts", "itemsets_pairs"}
    assert data["value"] == pytest.approx(sum(data["queries"].values()), abs=1e-3)
