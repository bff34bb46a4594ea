"""Driver contract: entry runs, every oracle key is a registered query."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rolling_cost_90d" in df.columns


def test_oracle_keys_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 68


@pytest.mark.parametrize("gone", [["claimspark/llm", "corpus_pipeline.py"], ["claimspark/llm"], ["corpus_pipeline.py"]])
def test_the_library_works_without_the_llm_folders(tmp_path, gone):
    """queries() and oracle_sql() in a copy that lacks them; a left-over cache folder does not count as a module."""
    away = [os.path.join(ROOT, g) for g in gone]
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [
        n for n in names if n in (".git", "tests") or os.path.join(folder, n) in away])
    if "claimspark/llm" in gone:
        os.makedirs(copy / "claimspark/llm/__pycache__")
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); "
            "print(len(q), sum(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)")
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr
    total, ops, pipeline = run.stdout.split()
    assert int(total) >= 68 and pipeline == "False" and (int(ops) == 0) == ("claimspark/llm" in gone)
