"""The entry module, with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

HERE = Path(__file__).parent.parent


def test_entry_imports_without_the_operators_for_training_data(tmp_path):
    """``corpus_pipeline.py`` may stay behind when the operators are taken away."""
    gone = {HERE / "docintake" / "llm", HERE / "tests" / "llm"}

    def ignored(folder, names):
        return [n for n in names if Path(folder, n) in gone or n in (".git", "__pycache__")]

    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=ignored)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    done = subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    from docintake.plans.oracles import ORACLES
    from docintake.plans.queries import QUERIES

    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"]
