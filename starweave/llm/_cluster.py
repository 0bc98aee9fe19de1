"""Small helpers that every operator of this subpackage shares.

``checkpointed`` cuts lineage in the shared folder of ``spark.checkpoint.dir``;
``kept`` does so with compressed Parquet, computed once, and drops the frames that
it replaces; ``Stages`` does the same for tables with names;
``small_side`` broadcasts a side only after its size was measured.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Largest side, in rows and in estimated bytes, that is sent to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's shared checkpoint folder; make one only where none is set (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="starweave-llm-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, *replaced: DataFrame) -> DataFrame:
    """The same rows, written once as compressed Parquet in the shared checkpoint folder.

    Afterwards the ``replaced`` frames, which ``kept`` returned before and which
    nothing reads any more, are dropped.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    dropped(*replaced)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete the rows of frames that ``kept`` returned; whatever else is given stays."""
    for frame in frames:
        if "kept_at" in vars(frame):
            delete(frame.sparkSession, frame.kept_at)


class Stages:
    """Intermediate tables of one run, as Parquet in a folder of its own under the shared checkpoint folder.

    A table that its successors have replaced is dropped by name, so the folder
    holds what is still to be read and nothing else.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, drop: tuple[str, ...] = ()) -> DataFrame:
        """The same rows, written as table ``name``; then the tables in ``drop`` go."""
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        for old in drop:
            self.drop(old)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.folder}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that a run of this subpackage has written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def small_side(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit the bound, else unchanged.

    ``df`` should be checkpointed: it is counted here, one number per task.
    """
    rows = df.count()
    if rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df
