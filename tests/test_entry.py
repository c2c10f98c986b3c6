"""The entry module with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

NAMES = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"


def _names(folder):
    done = subprocess.run([sys.executable, "-B", "-c", NAMES], cwd=folder, env=os.environ | {"PYTHONPATH": folder}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_entry_without_the_optional_subpackage(scratch_dir):
    from relaylens.plans import registry

    tree = os.path.join(scratch_dir, "tree")

    def left_out(folder, names):
        away = {".git", "__pycache__"} & set(names)
        return away | ({"llm"} & set(names) if os.path.basename(folder) in ("relaylens", "tests") else set())

    shutil.copytree(ROOT, tree, ignore=left_out)
    for present in (True, False):  # with the pipeline's file beside, and without it
        if not present:
            os.remove(os.path.join(tree, "corpus_pipeline.py"))
        queries, sql = _names(tree).split("|")
        assert set(queries.split()) == set(registry.QUERIES)
        assert set(sql.split()) == set(registry.oracle_sql())
