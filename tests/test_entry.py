"""The driver's entry without the training-data package, or without a library of it."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder, before="pass"):
    code = f"import sys; {before}; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
        env=os.environ | {"PYTHONDONTWRITEBYTECODE": "1"},
    )
    if run.returncode:
        raise AssertionError(run.stderr)
    queries, oracles = run.stdout.strip().splitlines()
    return set(queries.split()), set(oracles.split())


@pytest.fixture
def copy(tmp_path):
    for name in ("siltstone", "tests"):
        left = shutil.ignore_patterns("llm", "__pycache__")
        shutil.copytree(f"{REPO}/{name}", tmp_path / name, ignore=left)
    for name in ("__spark_entry__.py", "check.py", "bench.py"):
        shutil.copy(f"{REPO}/{name}", tmp_path)
    return tmp_path


def test_without_the_package(copy):
    from siltstone.plans.oracles import ORACLES
    from siltstone.plans.queries import QUERIES

    queries, oracles = names(copy)
    assert queries == set(QUERIES) and oracles == set(ORACLES)
    assert names(copy, "import check, bench")[0] == queries


def test_pipeline_left_behind(copy):
    source = "from siltstone.llm.common import stored\nORACLE_SQL = None\n"
    (copy / "corpus_pipeline.py").write_text(source)
    assert "pipeline" not in names(copy)[0]


def test_library_missing(copy):
    from siltstone.plans.queries import QUERIES

    (copy / "siltstone/llm").mkdir()
    (copy / "siltstone/llm/__init__.py").write_text("")
    (copy / "siltstone/llm/oracles.py").write_text("ORACLES = {}")
    (copy / "siltstone/llm/queries.py").write_text("import tiktoken\nQUERIES = {}")
    assert names(copy, "sys.modules['tiktoken'] = None")[0] == set(QUERIES)


def test_other_errors_are_not_hidden(copy):
    (copy / "siltstone/llm").mkdir()
    (copy / "siltstone/llm/__init__.py").write_text("")
    (copy / "siltstone/llm/queries.py").write_text("QUERIES = {}")
    (copy / "siltstone/llm/oracles.py").write_text("import siltstone.operators.absent")
    with pytest.raises(AssertionError, match="siltstone.operators.absent"):
        names(copy)
