"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="rp_monthly_kpis,win_running_range")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout
    lines = [x for x in out.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"rp_monthly_kpis", "win_running_range"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
