"""The operators reach Python workers that do not have the package on their path."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import corpus_pipeline
from siltstone.llm.queries import QUERIES
folder = "/root/testdata/sf0.001"
docs = spark.read.parquet(folder + "/documents.parquet")
# Stages first: no query has handed the package over by then.
for name, stage in corpus_pipeline.STAGES:
    print("rows", name, stage(spark, docs, folder).count() > 0)
for name in QUERIES:
    print("rows", name, QUERIES[name](spark, folder).count() > 0)
print("rows", "pipeline", corpus_pipeline.run(spark, folder).count() > 0)
"""


def test_all_queries_and_stages_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    told = [line.split()[-1] for line in run.stdout.splitlines() if line.startswith("rows")]
    assert told == ["True"] * 19, run.stderr[-2000:]
