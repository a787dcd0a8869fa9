"""The driver's entry without the corpus operators or the libraries that only they use."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{absent!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert names == set(entry.base_queries()) == set(entry.oracle_sql()), names ^ set(entry.oracle_sql())
print(len(names))
"""


@pytest.mark.parametrize("absent", ["xxhash", "sentencepiece", "publicspend.llm", "corpus_pipeline"])
def test_base_queries_stand_alone(absent):
    probe = PROBE.format(root=str(ROOT), absent=absent)
    done = subprocess.run([sys.executable, "-c", probe], capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 70
