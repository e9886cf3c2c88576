"""Queries run from any folder: the package travels to the Python workers with the job."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from tests.conftest import SF

ROOT = Path(__file__).resolve().parents[1]
NAMES = (
    "cont_profile_tree", "tree_thresholds", "all_profiles", "nominal_profile", "nominal_recode", "pareto_trials",
    "trial_choice", "boosting_search", "stage_train",
)

SCRIPT = f"""
import importlib.util, os, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {str(ROOT / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
for name in {NAMES!r}:
    print(name, entry.queries()[name](spark, {SF!r}).count() > 0)
"""


def test_from_a_foreign_folder(tmp_path):
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert all(f"{name} True" in done.stdout for name in NAMES)
