import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_bench_prints_one_json_line():
    settings = {
        "BENCH_SF_DIR": "/root/testdata/sf0.001",
        "BENCH_CPUS": "2",
        "BENCH_RUNS": "1",
    }
    done = subprocess.run(
        [sys.executable, str(ROOT / "bench.py"), "status_census", "next_processed"],
        env={**os.environ, **settings},
        cwd="/",
        capture_output=True,
        text=True,
        check=True,
        timeout=300,
    )
    lines = done.stdout.splitlines()
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert set(result["queries"]) == {"status_census", "next_processed"}
    assert result["unit"] == "sec" and result["sf"] == "0.001" and result["value"] > 0
