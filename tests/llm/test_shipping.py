"""Python workers find the package without sharing the driver's import path or working folder."""

import os
import subprocess
import sys
from pathlib import Path

import placemill

from ..conftest import TESTDATA

_PROGRAM = f"""
import sys
sys.path.insert(0, {str(Path(placemill.__file__).parent.parent)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from placemill.llm import queries
names = ("op7_bpe_encoding", "op8_ngram_jaccard_join", "op9_training_order", "op10_benchmark_decontamination")
print("ROWS", *[queries.QUERIES[name](spark, "{TESTDATA}/sf0.001").count() for name in names])
"""


def test_a_driver_elsewhere(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", _PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    rows = done.stdout.split("ROWS")[-1].split()
    assert len(rows) == 4 and rows[0] == rows[1] == rows[3] == "200", done.stderr[-2000:]
