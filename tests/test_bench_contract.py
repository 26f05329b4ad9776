"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "count_by_group_ranked"],
                         capture_output=True, text=True, timeout=600, env=env)
    lines = out.stdout.strip().splitlines()
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and res["sf"] == 0.001 and "count_by_group_ranked" in res["queries"]
