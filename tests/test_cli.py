import json
import os
import subprocess
import sys
import tempfile

from support import ROOT, SF_SMALL


def test_cli_all_jobs_on_test_tables():
    out = tempfile.mkdtemp(prefix="cartwright-cli-")
    env = {**os.environ, "PYTHONPATH": ROOT}
    proc = subprocess.run(
        [sys.executable, "-m", "cartwright", "all", "--tables", SF_SMALL, "--out", out,
         "--master-url", "local[2]"],
        capture_output=True, text=True, timeout=600, env=env, cwd=ROOT)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [json.loads(ln) for ln in proc.stdout.splitlines() if ln.startswith("{")]
    transform, reports = lines[0], lines[1]
    assert transform["master_rows"] == transform["source_rows"]["orders"] > 0
    assert set(reports) == {"order_status", "monthly_revenue", "state_performance",
                            "running_revenue", "delivery_analysis"}
    for path in reports.values():
        assert os.path.exists(os.path.join(path, "_SUCCESS"))
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
