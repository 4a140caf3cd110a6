"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF001, "BENCH_CPUS": "2",
           "BENCH_QUERIES": "id_in,sort_limit"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"id_in", "sort_limit"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
