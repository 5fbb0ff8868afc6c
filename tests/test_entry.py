"""The entry module without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 100 and set(entry.oracle_sql()) <= names, names
assert not [n for n in names if n.startswith("op") or n == "pipeline"]
print("imported")
"""


def test_import_without_the_llm_folder(tmp_path):
    """``corpus_pipeline.py`` may stay behind when ``commentlens/llm`` is gone."""
    shutil.copytree(f"{ROOT}/commentlens", tmp_path / "commentlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "imported" in done.stdout, done.stderr[-2000:]
