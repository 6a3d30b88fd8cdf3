"""The entry must load without the training-data subpackage, or without a library that it needs."""

import os
import shutil
import subprocess
import sys

from tests.conftest import ROOT

LIST = "import __spark_entry__ as E; assert E.queries().keys() >= E.oracle_sql().keys(); print(*E.queries())"


def names(folder, before=""):
    done = subprocess.run([sys.executable, "-c", before + LIST], cwd=folder, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def copy(tmp_path, *left_out):
    """The code alone: other files of the folder may come and go meanwhile."""
    to = tmp_path / "copy"
    to.mkdir(parents=True)
    skip = shutil.ignore_patterns("__pycache__", *left_out)
    shutil.copytree(os.path.join(ROOT, "gridloom"), to / "gridloom", ignore=skip)
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), to)
    return to


def test_without_the_subpackage(tmp_path):
    whole = names(ROOT)
    left = names(copy(tmp_path, "llm"))
    assert left == names(copy(tmp_path / "both", "llm", "corpus_pipeline.py"))
    assert len(left) > 90 and all(n == "pipeline" or n.startswith("op") for n in whole - left)


def test_without_a_library_of_the_subpackage():
    left = names(ROOT, "import sys; sys.modules['public_tokenizers'] = None; ")
    assert len(left) > 90 and not any(n == "pipeline" or n.startswith("op1_") for n in left)
