"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="type_filter,line_names")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"type_filter", "line_names"} and d["value"] > 0
    assert "errors" not in d
