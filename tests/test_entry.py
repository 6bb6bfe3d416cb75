"""The entry point without the corpus operators, or without what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

from fleetgauge.plans.catalog import CATALOG

REPOSITORY = Path(__file__).resolve().parent.parent

HIDING = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
found = entry.queries()
assert set(entry.oracle_sql()) <= set(found)
print(len(found), "pipeline" in found)
"""


@pytest.mark.parametrize("name", ["xxhash", "numpy", "fleetgauge.llm", "fleetgauge.llm.queries", "corpus_pipeline"])
def test_entry_without_a_module(name):
    found = subprocess.run(
        [sys.executable, "-B", "-c", HIDING.format(name=name)], cwd=REPOSITORY, capture_output=True, text=True, timeout=120
    )
    assert found.returncode == 0, found.stderr
    number, pipeline = found.stdout.split()
    assert int(number) >= len(CATALOG) and pipeline == "False"
