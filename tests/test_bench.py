"""bench.py prints one JSON line with the keys the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "classify", "count_statistics"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["metric"] == "total_query_seconds" and result["unit"] == "sec"
    assert set(result["queries"]) == {"classify", "count_statistics"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert result["sf"] == 0.001
