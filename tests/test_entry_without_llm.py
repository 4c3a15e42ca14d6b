"""The library imports, and registers its own queries, without the training-data subpackage."""

import json
import os
import shutil
import subprocess
import sys

import pytest

from servicelens.plans.registry import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("pipeline_left", [True, False])
def test_import_without_the_subpackage(tmp_path, pipeline_left):
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline_left else ["corpus_pipeline.py"]))
    shutil.copytree(REPO, copy, ignore=skip)
    assert not (copy / "servicelens" / "llm").exists() and not (copy / "tests" / "llm").exists()
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", SAYS], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    names, oracles = json.loads(out.stdout)
    assert names == sorted(QUERIES) and set(oracles) <= set(names) and len(oracles) > 50


def test_nothing_outside_reads_the_subpackage():
    for top, folders, files in os.walk(os.path.join(REPO, "servicelens")):
        folders[:] = [f for f in folders if f != "llm"]
        for f in (f for f in files if f.endswith(".py")):
            assert "servicelens.llm" not in open(os.path.join(top, f)).read(), f
