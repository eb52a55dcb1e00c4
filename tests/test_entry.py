import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


@pytest.fixture
def copy(tmp_path):
    """The repository without the subpackage for training data and its pipeline."""
    target = tmp_path / "repo"
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "tests"))
    return target


def imported(folder):
    return subprocess.run([sys.executable, "-c", COUNT], capture_output=True, text=True, cwd=folder)


def test_the_rest_works_without_the_subpackage(copy):
    total, own = map(int, imported(copy).stdout.split())
    assert total > 65 and own == 0
    (copy / "palate" / "llm" / "__pycache__").mkdir(parents=True)  # what is left behind is no subpackage
    assert imported(copy).stdout.split() == [str(total), "0"]


def test_a_broken_subpackage_is_an_error(copy):
    (copy / "palate" / "llm").mkdir()
    (copy / "palate" / "llm" / "__init__.py").write_text("")
    (copy / "palate" / "llm" / "registry.py").write_text("import no_such_module")
    (copy / "corpus_pipeline.py").write_text("run = ORACLE_SQL = None")
    assert "no_such_module" in imported(copy).stderr
