"""The queries outside the corpus part do not depend on it or on the modules that it alone needs."""

import subprocess
import sys
from pathlib import Path

import pytest

HOME = Path(__file__).resolve().parents[1]
CODE = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError("blocked", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
names = set(e.queries())
print(len(names), any(n.startswith("op1") for n in names), set(e.oracle_sql()) <= names, bool(e.CORPUS_MISSING))
"""
MODULES = ["ahocorasick", "public_tokenizers", "sentencepiece", "corpus_pipeline", "storelens.llm"]


@pytest.mark.parametrize("name", MODULES)
def test_other_queries_are_listed_without_a_module_of_the_corpus_part(name):
    out = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=HOME, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    count, corpus, listed, missing = out.stdout.split()
    assert int(count) >= 98 and (corpus, listed, missing) == ("False", "True", "True")
