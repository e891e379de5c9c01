"""Session helpers."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
from lagwatch.session import get_session
spark = get_session("shipped", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
from lagwatch.plans import catalog
print("rows", catalog.lag_24h_p95(spark, "/root/testdata/sf0.001").count())
"""


def test_workers_import_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 1000" in ran.stdout, ran.stderr[-2000:]
