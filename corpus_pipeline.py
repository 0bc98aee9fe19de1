"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet in
the shared checkpoint folder and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starweave.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from starweave.llm._cluster import ensure_checkpoint_dir

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("minhash_near_dedup", near_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

#: Near-duplicate search, a learned toxicity model and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:  # what this run wrote for the stage that has ended
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(last)
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
        last = path
    return docs
