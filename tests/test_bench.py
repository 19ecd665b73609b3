"""bench.py prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_RUNS="1", BENCH_QUERIES="row_count,customer_etl", BENCH_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and "errors" not in d
    assert set(d["queries"]) == {"row_count", "customer_etl"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
    assert d["per_query_io"]["customer_etl"]["input_rows"] > 0
