"""The library without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"


@pytest.fixture(params=[True, False], ids=["with pipeline file", "without it"])
def rest(tmp_path, request):
    left_out = {REPO / "storetally" / "llm", REPO / "tests" / "llm", REPO / ".git"}
    if not request.param:
        left_out.add(REPO / "corpus_pipeline.py")

    def ignore(folder, names):
        return [name for name in names if Path(folder) / name in left_out or name == "__pycache__"]

    return Path(shutil.copytree(REPO, tmp_path / "rest", ignore=ignore))


def test_rest_stands_alone(rest):
    said = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=rest, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names = said.stdout.split("SQL")[0].split()[1:]
    assert "sales_by_segment_share" in names
    assert not [name for name in names if name.startswith("op") or name == "pipeline"]
    assert set(said.stdout.split("SQL")[1].split()) <= set(names)
