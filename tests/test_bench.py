"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1",
               BENCH_CPUS="2", BENCH_ONLY="station_ids,monthly_avg_temp_c")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] == "total_query_seconds" and result["unit"] == "sec"
    assert set(result["queries"]) == {"station_ids", "monthly_avg_temp_c"}
    assert result["sf"] == 0.001 and result["value"] > 0
