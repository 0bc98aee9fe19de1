"""Parquet tables: append, overwrite-by-new-version, staging, partition publish.

* Row counts come from ``DataFrame.observe`` on the write itself, not a
  second ``count()`` job that would recompute the whole lineage.
* Spark refuses to overwrite a path it is reading. An overwrite therefore
  writes the next version directory ``<root>/<name>/v000123`` and readers
  take the highest version whose write committed (``_SUCCESS`` present).
  Old versions stay until ``vacuum``. One writer per table at a time.
* A table that is appended to or published keeps its columns in one small file
  beside its data (``_columns.json``), written before the data: planning an
  append or a read lists and opens no data file, however long the history.
* ``stage`` writes an intermediate result into the cluster's shared
  checkpoint folder (``spark.checkpoint.dir``) and reads it back: the
  lineage is cut there, so a lost executor re-reads the staged files
  instead of recomputing everything upstream.
"""
from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.upsert import MERGE_ACTION, upsert

VERSION_PREFIX = "v"
# The log of a table's columns; Spark's readers skip names that begin with "_".
COLUMNS_FILE = "_columns.json"
#: Parquet bytes that a task reads at most while a table is written. Layers with columns of few values are 10 to 20
#: times as large in memory, and Spark's 128 MB of them do not fit a task's share for a sort or a hash map: it spills.
SPLIT_BYTES = 16 << 20
_SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
_split_lock = threading.Lock()
_split_users: dict = {}


@contextmanager
def small_splits(spark: SparkSession):
    """Inside, jobs of the session read at most ``SPLIT_BYTES`` a task (its own setting, where that is less).
    Layers are written by several threads: the last one out puts the session's setting back."""
    key = id(spark._jsparkSession)
    with _split_lock:
        users, own = _split_users.get(key, (0, None))
        if not users:
            own = spark.conf.get(_SPLIT_CONF)
            given = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own))
            if given > SPLIT_BYTES:
                spark.conf.set(_SPLIT_CONF, str(SPLIT_BYTES))
        _split_users[key] = (users + 1, own)
    try:
        yield
    finally:
        with _split_lock:
            users, own = _split_users.pop(key)
            if users > 1:
                _split_users[key] = (users - 1, own)
            else:
                spark.conf.set(_SPLIT_CONF, own)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def has_checkpoint_root(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file beside a table's data, replaced as a whole: written under another name, then renamed."""
    fs, p = _fs(spark, path)
    fresh = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{p.getParent()}/_{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(fresh, p):  # stores that don't rename over an old file
        fs.delete(p, False)
        fs.rename(fresh, p)


def get_text(spark: SparkSession, path: str) -> str | None:
    """What ``put_text`` wrote, or None."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def logged_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns that ``log_schema`` kept, or None for a folder without them."""
    text = get_text(spark, f"{path}/{COLUMNS_FILE}")
    return StructType.fromJson(json.loads(text)) if text else None


def log_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Add the columns of ``schema`` that the table lacks to its log. Called before their data is
    written: a column without data reads as NULL, data without its column would be lost."""
    old = logged_schema(spark, path)
    held = old.names if old else []
    whole = StructType([*(old or []), *[StructField(f.name, f.dataType, True) for f in schema if f.name not in held]])
    if old is None or len(whole) > len(old):
        put_text(spark, f"{path}/{COLUMNS_FILE}", whole.json())
    return whole


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (must be set on a cluster)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    return root.rstrip("/")


def write(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(), name: str = "rows",
          cluster_by=(), num_files: int | None = None, sort_by=(), dynamic: bool = False, codec: str | None = None,
          spread: bool = True) -> int:
    """Write Parquet and return the number of rows written (observed, one job). The tasks read small splits.

    A partitioned write is range-partitioned on (partition columns,
    ``cluster_by``) first: each task then writes one contiguous run of
    partition values instead of a file into every partition it happens to
    hold, and a hot partition value is still split across tasks by the
    clustering columns. Without ``num_files`` adaptive execution sizes the
    tasks by their data. ``spread=False`` leaves out that shuffle, for rows
    that already lie by ranges of the partition columns.
    """
    if partition_by and spread:
        order = [*partition_by, *cluster_by]
        df = df.repartitionByRange(num_files, *order) if num_files else df.repartitionByRange(*order)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if codec:
        w = w.option("compression", codec)
    with small_splits(df.sparkSession):
        w.parquet(path)
    return int(obs.get["rows"])


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder finished; a half-written first load is no table."""
    return exists(spark, f"{path}/_SUCCESS")


def read(spark: SparkSession, path: str, known: StructType | None = None) -> DataFrame:
    """A Parquet folder with the columns of all its files (evolved ones too).

    Columns of ``known`` have its types. The table's own log of columns is used
    where there is one, and no data file is opened; a folder without (written by
    something else) has its footers merged. Spark guesses the types of partition
    columns from folder names ('01' becomes 1, '2024-1-6' a date), so a partition
    column that is in neither comes back as a string.
    """
    logged = logged_schema(spark, path)
    if logged is not None:
        types = {f.name: f.dataType for f in (known or [])}
        return spark.read.schema(StructType([StructField(f.name, types.get(f.name, f.dataType), True) for f in logged])).parquet(path)
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    types = {f.name: f.dataType for f in (known or [])}
    folders = _partition_columns(spark, path)
    fields = [StructField(f.name, types.get(f.name, StringType() if f.name in folders else f.dataType), True) for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def _partition_columns(spark: SparkSession, path: str) -> set[str]:
    """Names of the folder levels ``name=value`` below a table's folder."""
    fs, p = _fs(spark, path)
    names: set[str] = set()
    while True:
        below = next((s.getPath() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()), None)
        if below is None:
            return names
        names.add(below.getName().split("=", 1)[0])
        p = below


def append(df: DataFrame, path: str, partition_by=(), cluster_by=()) -> int:
    """Append to a table; a rerun appends again (Silver's dedup absorbs it).

    New columns are added, missing ones are NULL; no value is converted (see ``read``).
    """
    spark = df.sparkSession
    if exists(spark, path):
        current = logged_schema(spark, path)
        if current is None:  # the log begins with what is there
            current = log_schema(spark, path, read(spark, path).schema)
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in current if f.name not in df.columns})
        df = df.select(*current.names, *[c for c in df.columns if c not in current.names])
    log_schema(spark, path, df.schema)
    return write(df, path, "append", partition_by, cluster_by=cluster_by)


def stage(df: DataFrame, label: str = "stage", partition_by=(), track: list | None = None) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a reader of it.
    The folder is appended to ``track`` when given (see ``drop_paths``)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    write(df, path, "overwrite", partition_by, codec="zstd")
    if track is not None:
        track.append(path)
    return spark.read.parquet(path)


def drop_paths(spark: SparkSession, paths: list) -> None:
    """Delete folders this process staged (never anything it did not create)."""
    jvm = spark.sparkContext._jvm
    while paths:
        path = paths.pop()
        fs, p = _fs(spark, path)
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


class TableStore:
    """Versioned Parquet tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def versions(self, name: str) -> list[int]:
        fs, p = _fs(self.spark, self._dir(name))
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if n.startswith(VERSION_PREFIX) and n[1:].isdigit():
                ok = fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
                if ok:
                    out.append(int(n[1:]))
        return sorted(out)

    def current_path(self, name: str) -> str | None:
        v = self.versions(name)
        return f"{self._dir(name)}/{VERSION_PREFIX}{v[-1]:06d}" if v else None

    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str, schema=None) -> DataFrame:
        path = self.current_path(name)
        if path is None:
            raise FileNotFoundError(f"table {name} has no committed version under {self.root}")
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)

    def commit(self, name: str, df: DataFrame, partition_by=(), cluster_by=()) -> tuple[str, int]:
        """Write ``df`` as the next version; returns (path, rows)."""
        v = self.versions(name)
        path = f"{self._dir(name)}/{VERSION_PREFIX}{(v[-1] + 1 if v else 1):06d}"
        rows = write(df, path, "overwrite", partition_by, cluster_by=cluster_by)
        return path, rows

    def merge(self, name: str, source: DataFrame, keys, update_cols, now=None, partition_by=(),
              only_changed: bool = True, zorder_by=()) -> tuple[str, int]:
        """Create on first load, else Type 1 upsert into a new version;
        ``zorder_by`` clusters the new version's files on those columns."""
        merged = source if not self.exists(name) else \
            upsert(self.read(name), source, keys, update_cols, now, only_changed)
        staged: list = []
        if zorder_by:
            from .layout import zorder
            merged = zorder(stage(merged, "merge", track=staged), list(zorder_by))
        done = self.commit(name, merged, partition_by)
        drop_paths(self.spark, staged)
        return done

    def row_counts(self, names) -> DataFrame:
        """``(layer, name)`` pairs → layer, table_name, row_count; a table with
        no committed version is reported with a NULL count, not an error."""
        parts = []
        for layer, name in names:
            if self.exists(name):
                df = self.read(name).agg(F.count(F.lit(1)).alias("row_count"))
            else:
                df = self.spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
            parts.append(df.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def vacuum(self, name: str, keep: int = 2) -> list[str]:
        fs, _ = _fs(self.spark, self._dir(name))
        dropped = []
        for v in self.versions(name)[:-keep]:
            path = f"{self._dir(name)}/{VERSION_PREFIX}{v:06d}"
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)
            dropped.append(path)
        return dropped


def _any_of(column: str, values) -> Column:
    """``column`` is one of the literal ``values`` (NULL included): prunes folders at planning."""
    some = [v for v in values if v is not None]
    hit = F.col(column).isin(some) if some else F.lit(False)
    return hit | F.col(column).isNull() if any(v is None for v in values) else hit


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder name that Spark's writer gives a partition value."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{escape(column)}={escape(str(value))}"


def _partitions(spark: SparkSession, table_path: str, partition_col: str, values, known: StructType) -> DataFrame:
    """The rows of some partitions. Only their folders are listed; columns that ``known`` lacks come from the
    table's log, or from the files of these folders where it has none (a rewrite must not lose one)."""
    wanted = {partition_folder(spark, partition_col, v) for v in values}
    fs, p = _fs(spark, table_path)  # one listing instead of a question for each value
    folders = [f"{table_path}/{name}" for name in sorted(wanted & {s.getPath().getName() for s in fs.listStatus(p)})]
    if not folders:
        return spark.createDataFrame([], known)
    found = logged_schema(spark, table_path)
    if found is None:
        found = spark.read.option("mergeSchema", "true").option("basePath", table_path).parquet(*folders).schema
    extra = [f for f in found if f.name not in known.names]
    rows = spark.read.schema(StructType([*known, *extra])).option("basePath", table_path).parquet(*folders)
    return rows.filter(_any_of(partition_col, values))


def publish_partitions(source: DataFrame, table_path: str, keys, update_cols, partition_col: str,
                       now=None, only_changed: bool = True, sort_by=(),
                       source_is_staged: bool = False, laid: bool = False,
                       follow: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Type 1 upsert into a partitioned table, rewriting only touched partitions.

    1. The target's key and partition columns are read to find the partitions
       that hold source keys. These and the source's own partitions, a bounded
       list of values, become literal filters, so nothing else is listed or read.
    2. The rows there are merged and staged. Touched are the partitions of
       inserted and updated rows, and those that updated rows left.
    3. Touched partitions are written with dynamic partition overwrite;
       partitions left empty by a move are deleted.

    Not atomic across partitions: run one writer per table. A crash between the
    overwrite and the deletes of step 3 leaves a moved row in both partitions;
    the next publish of that key keeps the latest (by ``updated_at``, then the
    row that is in the source's partition). ``sort_by`` orders rows inside every
    written file. A first load whose rows already lie by ranges of (partition column, keys) (``laid``) is written as it
    lies. ``follow`` adds columns that follow from a row's others, all of which a publish may update: ``source`` lacks
    them, and the rows that are there are merged, staged and dealt without them too. Staged folders are dropped at
    the end. Returns, among others, the ``values`` of the touched partitions (None: the table was created).
    """
    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    whole = follow or (lambda df: df)
    if not committed(spark, table_path):
        dealt = source if laid else source.repartitionByRange(partition_col, *keys)
        rows = write(whole(dealt), table_path, "overwrite", [partition_col], sort_by=sort_by, codec="zstd", spread=False)
        log_schema(spark, table_path, whole(source).schema)  # an overwrite empties the folder first
        return {"created": True, "rows": rows, "touched": None, "emptied": [], "values": None}
    staged: list = []
    if not source_is_staged:  # read several times below: evaluate it once
        source = stage(source, "source", track=staged)
    slim = StructType([f for f in source.schema if f.name in (*keys, partition_col)])
    everywhere = spark.read.schema(slim).parquet(table_path)
    held = stage(everywhere.select(*keys, partition_col).join(source.select(*keys).distinct(), keys, "left_semi"), "held", track=staged)
    near = {r[0] for r in held.select(partition_col).union(source.select(partition_col)).distinct().collect()}
    made = [c for c in whole(source).columns if c not in source.columns]
    target = _partitions(spark, table_path, partition_col, near, source.schema).drop(*made).withColumn("__from", F.col(partition_col))
    again = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    healed = not again.isEmpty()
    if healed:  # an interrupted publish left several rows of a key
        home = source.select(*keys, F.col(partition_col).alias("__home"))
        latest = [F.col("updated_at").desc_nulls_last()] if "updated_at" in target.columns else []
        order = Window.partitionBy(*keys).orderBy(*latest, F.col("__from").eqNullSafe(F.col("__home")).desc(), F.col("__from").desc_nulls_last())
        twice = target.join(again, keys, "left_semi").join(home, keys, "left")
        one = twice.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n", "__home")
        target = target.join(again, keys, "left_anti").unionByName(one)
    merged = stage(upsert(target, source, keys, update_cols, now, only_changed, with_action=True), "merged", track=staged)
    moved = merged.filter(F.col(MERGE_ACTION).isin("insert", "update"))
    touched = {r[0] for r in moved.select(partition_col).union(moved.filter(F.col(MERGE_ACTION) == "update").select("__from")).distinct().collect()}
    if healed:
        touched |= {r[0] for r in held.join(again, keys, "left_semi").select(partition_col).distinct().collect()}
    emptied = []
    if touched:
        out = merged.filter(_any_of(partition_col, touched)).drop(MERGE_ACTION, "__from")
        if logged_schema(spark, table_path) is not None:
            log_schema(spark, table_path, whole(out).schema)
        write(whole(out.repartitionByRange(partition_col, *keys)), table_path, "overwrite", [partition_col], sort_by=sort_by,
              dynamic=True, codec="zstd", spread=False)
        left = {r[0] for r in out.select(partition_col).distinct().collect()}
        emptied = sorted(touched - left, key=str)
        fs, _ = _fs(spark, table_path)
        for value in emptied:
            folder = partition_folder(spark, partition_col, value)
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_path}/{folder}"), True)
    drop_paths(spark, staged)
    return {"created": False, "touched": len(touched), "emptied": [str(v) for v in emptied], "values": sorted(touched, key=str)}
