"""Session settings and the shared folder that multi-pass operators write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes, so nothing in this package carries a broadcast hint.
# Forcing the skew rule lets it split a hot join key even where that costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Key pads are 64-byte binary literals; keep them out of printed plans.
    "spark.sql.redaction.string.regex": "(?i)(X'|0x)[0-9A-F]{128}'?",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local master may fall back to a temporary folder; on a cluster the executors would
    not see it, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="pitlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/pitlake/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several passes: the lineage is cut, a lost executor re-reads files
    instead of recomputing, and values that depend on a sampled partitioning become fixed.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(table: DataFrame) -> None:
    """Delete a table that ``stage`` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use the whole cluster for heavy per-row work on a table that was stored in a few splits.

    Plans with a shuffle and tables with enough splits come back unchanged, so a large table is
    never moved for this.
    """
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution().executedPlan()
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if plan.nodeName() == "AdaptiveSparkPlan" or plan.execute().getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks)


PARTITION_BYTES = 16 << 20  # stored bytes that one task of an iterative fit reads


def sized(table: DataFrame) -> DataFrame:
    """A written table in as many partitions as its bytes ask for, so that many passes over a small one cost few tasks."""
    spark = table.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    stored = sum(size for _, size, _ in table_state(spark, *sorted(paths)))
    return table.coalesce(max(1, -(-stored // PARTITION_BYTES)))


def table_state(spark: SparkSession, *paths: str) -> tuple:
    """(path, length, modification time) of every file below the paths: changes whenever a table does."""
    found = []
    for path in paths:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a path; none if it is not there."""
    if not path_exists(spark, path):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    return sorted(f.getPath().toString() for f in found if f.isDirectory())


def swap_into_place(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a finished staging folder over ``target`` (the old table is only then replaced)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    source, final, old = make(staged), make(target), make(f"{target}.previous")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(final.getParent())
    if fs.exists(old) and not fs.exists(final):
        fs.rename(old, final)  # a run stopped between the two renames; the old table is the only copy
    if fs.exists(old):
        fs.delete(old, True)
    if fs.exists(final):
        fs.rename(final, old)
    if not fs.rename(source, final):
        if fs.exists(old):
            fs.rename(old, final)
        raise RuntimeError(f"could not move {staged} to {target}")
    if fs.exists(old):
        fs.delete(old, True)
