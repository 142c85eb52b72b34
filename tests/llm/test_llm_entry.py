"""Registration of the queries, and that nothing else needs this package."""

import os
import re
import subprocess
import sys

import __spark_entry__
from opdiag.llm.oracle import SQL
from opdiag.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(QUERIES)


def test_the_rest_imports_without_this_package(tmp_path):
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "opdiag", ".git"):
            os.symlink(os.path.join(ROOT, name), tmp_path / name)
    (tmp_path / "opdiag").mkdir()
    for name in os.listdir(os.path.join(ROOT, "opdiag")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "opdiag", name), tmp_path / "opdiag" / name)
    entry = (tmp_path / "__spark_entry__.py")
    text = entry.read_text()
    entry.unlink()
    entry.write_text(text)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k[:2] == 'op' for k in e.queries()))"
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    ).stdout.split()
    assert int(out[0]) >= 68 and out[1] == "False"
