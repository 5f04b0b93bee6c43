"""The entry without the training-data subpackage, and with a broken one."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _count(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, env=os.environ | {"PYTHONPATH": folder})


def test_the_entry_needs_no_training_data_operators(tmp_dir):
    shutil.copytree(f"{ROOT}/pricepanel", f"{tmp_dir}/pricepanel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_dir)
    bare = _count(tmp_dir)
    assert bare.returncode == 0, bare.stderr
    queries, oracles = map(int, bare.stdout.split())
    assert queries == oracles and queries >= 92
    # an empty folder (left-over caches) counts as absent, a fault inside does not
    os.makedirs(f"{tmp_dir}/pricepanel/llm")
    assert _count(tmp_dir).stdout == bare.stdout
    for name, text in [("__init__.py", ""), ("queries.py", "import a_module_that_is_missing")]:
        with open(f"{tmp_dir}/pricepanel/llm/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    broken = _count(tmp_dir)
    assert broken.returncode != 0 and "a_module_that_is_missing" in broken.stderr
