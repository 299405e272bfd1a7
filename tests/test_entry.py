"""The driver contract, with and without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q)"


def names(folder: Path) -> tuple[int, bool]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split()
    return int(said[0]), said[1] == "True"


@pytest.mark.parametrize("left", ["nothing", "pipeline", "pipeline and caches", "caches"])
def test_without_training_data_operators(tmp_path, left):
    for name in ("__spark_entry__.py", "confluo", *(["corpus_pipeline.py"] if "pipeline" in left else [])):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "confluo/llm", ignore_errors=True)
    if "caches" in left:
        (tmp_path / "confluo/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "confluo/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"")
    n, pipeline = names(tmp_path)
    assert n >= 130 and not pipeline


@pytest.mark.skipif(not (ROOT / "confluo/llm/queries.py").exists(), reason="no training-data operators here")
def test_an_error_inside_them_is_an_error(tmp_path):
    for name in ("__spark_entry__.py", "confluo", "corpus_pipeline.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    assert names(tmp_path)[1]
    (tmp_path / "confluo/llm/mixing.py").write_text("import a_module_that_is_not_there\n")
    with pytest.raises(subprocess.CalledProcessError):
        names(tmp_path)


def test_nothing_else_imports_them():
    for source in (ROOT / "confluo").rglob("*.py"):
        if "llm" not in source.parts:
            assert ".llm" not in source.read_text(), source
