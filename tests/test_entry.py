"""The entry points with and without the text operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copied(folder, *without):
    keep = ["__spark_entry__.py", "corpus_pipeline.py", "jobtide", "checks"]
    for name in keep:
        source, target = os.path.join(ROOT, name), os.path.join(folder, name)
        if name in without or not os.path.exists(source):
            continue
        if os.path.isdir(source):
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("__pycache__", *without))
        else:
            shutil.copy(source, target)


def counted(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})


def test_the_other_queries_work_without_text_operators(tmp_path):
    copied(tmp_path, "llm", "corpus_pipeline.py")
    done = counted(tmp_path)
    registered, with_sql = map(int, done.stdout.split())
    assert done.returncode == 0 and registered == with_sql > 90


def test_an_empty_folder_is_no_package(tmp_path):
    copied(tmp_path, "llm", "corpus_pipeline.py")
    os.makedirs(tmp_path / "jobtide" / "llm" / "__pycache__")
    assert counted(tmp_path).returncode == 0


@pytest.mark.skipif(not os.path.isdir(os.path.join(ROOT, "jobtide", "llm")), reason="no text operators here")
def test_a_broken_text_operator_is_an_error(tmp_path):
    copied(tmp_path)
    assert counted(tmp_path).returncode == 0
    with open(tmp_path / "jobtide" / "llm" / "common.py", "a") as module:
        module.write("\nimport a_module_that_is_missing\n")
    assert "a_module_that_is_missing" in counted(tmp_path).stderr
