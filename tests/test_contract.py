"""The contract module without the optional parts: left out, left over, or short of a module."""

import os
import shutil
import subprocess
import sys

import pytest

from grainline.plans import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(folder, before=""):
    code = f"{before}\nimport __spark_entry__ as e; print('registered', *sorted(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split("registered ", 1)[1].split())


@pytest.fixture
def copy(tmp_path):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{ROOT}/grainline", tmp_path / "grainline", ignore=skip)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def test_without_the_optional_parts(copy):
    assert registered(copy) == set(QUERIES)


def test_with_a_leftover_folder_and_a_pipeline_without_operators(copy):
    (copy / "grainline" / "llm" / "__pycache__").mkdir(parents=True)
    (copy / "corpus_pipeline.py").write_text("from grainline.llm import toxicity\n")
    assert registered(copy) == set(QUERIES)


def test_with_a_missing_module(copy):
    (copy / "grainline" / "llm").mkdir()
    (copy / "grainline" / "llm" / "__init__.py").write_text("")
    (copy / "grainline" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\nQUERIES = CHECKS = {}\n")
    assert registered(copy) == set(QUERIES)
