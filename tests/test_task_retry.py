"""Task failures and retries (what executor loss looks like to a stage) leave results exact."""

import json
import os
import subprocess
import sys


def test_results_survive_task_retries():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "task_retry.py")
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["counts_equal"] and res["keywords"] > 0
    assert res["stored"] == res["distinct"] == 1000
