"""The entry module without the training-data package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import importlib.util
found = importlib.util.find_spec
importlib.util.find_spec = lambda name, *a: None if name == "casewright.llm" else found(name, *a)
import __spark_entry__ as entry
names = set(entry.queries())
assert "a2_overall_stats" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
assert set(entry.oracle_sql()) <= names
"""


def test_entry_without_training_data_package():
    done = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
