"""The entry module works without the optional subpackage, in whatever state its folder is."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())))"


def _copy(tmp_path):
    for d in ("functions", "operators", "plans", "sources"):
        shutil.copytree(f"{ROOT}/biasfit/{d}", tmp_path / "biasfit" / d)
    for f in ("__init__.py", "schemas.py", "session.py"):
        shutil.copy(f"{ROOT}/biasfit/{f}", tmp_path / "biasfit" / f)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


@pytest.mark.parametrize("state", ["absent", "empty folder", "missing package"])
def test_entry_without_the_optional_subpackage(tmp_path, state):
    at = _copy(tmp_path)
    if state != "absent":
        (at / "biasfit/llm").mkdir()
    if state == "missing package":
        (at / "biasfit/llm/__init__.py").write_text("")
        (at / "biasfit/llm/queries.py").write_text("import a_package_that_is_not_installed\n")
        (at / "corpus_pipeline.py").write_text("")
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", COUNT], cwd=at, env=os.environ | {"PYTHONPATH": ""},
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-500:]
    n, extra = out.stdout.split(" ", 1)
    assert int(n) >= 41 and extra.strip() == "[]"
