"""The core queries stay when the corpus operators, or a library they need, are missing."""

import os
import subprocess
import sys

import pytest

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[: len({names!r})] == {names!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {home!r})
import __spark_entry__
from registry import QUERIES
assert set(__spark_entry__.queries()) == set(QUERIES), "other queries"
assert set(__spark_entry__.oracle_sql()) <= set(QUERIES)
"""


@pytest.mark.parametrize("missing", ["ahocorasick", "tidemark.llm", "corpus_pipeline"])
def test_core_queries_need_no_corpus_operators(missing):
    code = WITHOUT.format(names=missing.split("."), home=HOME)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
