"""bench.py prints one JSON line in the driver's format (run as its own process)."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_FORECAST="0", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "gold_daily_store_health",
                          "gold_supplier_risk"], env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] == "headline_total" and result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"gold_daily_store_health", "gold_supplier_risk"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
