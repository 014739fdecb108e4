"""The entry module of a copy that lacks the training-data part."""

import os
import shutil
import subprocess
import sys

import pytest

from oracle_sql import ORACLE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), e.llm, e.corpus_pipeline)"


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("caches", [True, False])
def test_entry_without_the_training_data_part(tmp_path, pipeline, caches):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    if caches:
        (copy / "platewright" / "llm" / "__pycache__").mkdir(parents=True)
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, env=clean, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(ORACLE)), str(len(ORACLE)), "None", "None"]
