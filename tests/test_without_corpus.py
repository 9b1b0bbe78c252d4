"""The library works where the corpus operators were taken out."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("leave_pipeline", [True, False])
@pytest.mark.parametrize("leave_folder", [True, False])
def test_entry_without_corpus_operators(tmp_path, leave_pipeline, leave_folder):
    """Also with the pipeline file left, or an empty folder of the operators."""
    shutil.copytree(os.path.join(ROOT, "opinionlens"), tmp_path / "opinionlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if leave_pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    if leave_folder:
        (tmp_path / "opinionlens" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), 'pipeline' in q, any(k.startswith('op1_') for k in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    n_queries, n_sql, *corpus = done.stdout.split()
    assert int(n_queries) >= 53 and int(n_sql) >= 44 and corpus == ["False", "False"]
