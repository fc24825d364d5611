"""The driver's contract where the subpackage, or a package that it alone needs, is absent."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCKED = """
import sys, warnings

class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "{0}" or name == "{0}":
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Block())
sys.path.insert(0, {1!r})
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len([q for q in entry.queries() if not q.startswith("op") and q != "pipeline"]))
print(len([q for q in entry.queries() if q.startswith("op")]), "pipeline" in entry.queries())
print([str(w.message) for w in seen if "left out" in str(w.message)])
"""


@pytest.mark.parametrize("absent, warned", [("ahocorasick", True), ("tiktoken", False), ("sensorloom.llm", False)])
def test_the_core_stands_alone(absent, warned):
    code = BLOCKED.format(absent, str(ROOT))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    core, extra, said = done.stdout.splitlines()[-3:]
    assert int(core) >= 49, done.stderr
    if absent == "tiktoken":
        # a package of the tests alone
        assert "True" in extra or not (ROOT / "corpus_pipeline.py").exists()
    else:
        assert extra == "0 False"
    assert ("ahocorasick" in said) == (warned and (ROOT / "corpus_pipeline.py").exists())
