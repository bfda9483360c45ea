from __future__ import annotations

import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/", 2)[0]
#: Makes one module impossible to import, as in an installation without it.
LACKING = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{module!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), any(name.startswith("op") and name[2].isdigit() for name in entry.queries()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("module", ["public_tokenizers", "caremeld.llm", "corpus_pipeline"])
def test_entry_works_without_what_may_be_left_out(module):
    done = subprocess.run([sys.executable, "-c", LACKING.format(root=ROOT, module=module)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    number, text_queries, pipeline = done.stdout.split()
    assert int(number) >= 88 and pipeline == "False"
    assert "left out" in done.stderr
    if module != "corpus_pipeline":
        assert text_queries == "False"
