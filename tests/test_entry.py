"""The entry points without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "the pipeline"])
def test_entry_without_the_corpus_operators(tmp_path, left):
    copy = tmp_path / "copy"
    shutil.copytree(f"{REPO}/saldoflow", copy / "saldoflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", copy)
    if left == "an empty folder":
        (copy / "saldoflow/llm").mkdir()
    if left == "the pipeline":
        shutil.copy(f"{REPO}/corpus_pipeline.py", copy)
    done = subprocess.run([sys.executable, "-c", SAY], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    queries, oracles, corpus = done.stdout.split(maxsplit=2)
    assert queries == oracles and corpus.strip() == "[]"


def test_nothing_else_imports_the_corpus_operators():
    found = subprocess.run(["grep", "-rlE", "^ *(from|import) .*(llm|corpus_pipeline)", "--include=*.py", "saldoflow", "tests", "bench.py"],
                           cwd=REPO, capture_output=True, text=True).stdout.split()
    assert [f for f in found if not f.startswith(("saldoflow/llm/", "tests/llm/")) and f != "tests/test_entry.py"] == []
