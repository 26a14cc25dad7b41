import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
import __spark_entry__ as e
from pyspark.sql import SparkSession
assert not [q for q in e.queries() if q.startswith("op") or q == "pipeline"], "training-data queries are there"
assert set(e.oracle_sql()) <= set(e.queries())
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert e.entry(spark).count() > 0
assert e.queries()["m04_present"](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_runs_without_the_training_data_folders(tmp_path):
    """As if tallyloom/llm, tests/llm and corpus_pipeline.py had been deleted."""
    shutil.copytree(os.path.join(ROOT, "tallyloom"), tmp_path / "tallyloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
