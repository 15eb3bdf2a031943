"""The entry without the training-data operators, which nothing else needs."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import __spark_entry__ as entry
from visitlens.session import build_session
names = list(entry.queries())
assert names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(entry.oracle_sql()) == set(names)
spark = build_session("local[2]", shuffle_partitions=2)
print("rows", entry.entry(spark).count())
spark.stop()
"""


def test_entry_without_the_training_data_operators(tmp_path):
    tree = tmp_path / "tree"
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json", ".pytest_cache")
    shutil.copytree(ROOT, tree, ignore=skip)
    assert not (tree / "visitlens" / "llm").exists() and (tree / "corpus_pipeline.py").exists()
    env = {**os.environ, "PYTHONPATH": str(tree)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tree, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "rows" in done.stdout
