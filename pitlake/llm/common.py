"""Small helpers that the text operators share."""

from __future__ import annotations

import ctypes
import gc

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.session import path_exists

HELD_OUT_FOLDS = 5
BATCH_ROWS = 2_000


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, so that a worker holds few whole texts at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def give_back() -> None:
    """Return what a task has freed to the system, so that a reused worker begins its next task small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def whole(texts: pd.Series) -> list[str]:
    """Texts of an Arrow batch; null counts as empty."""
    return [x if isinstance(x, str) else "" for x in texts]


def blocks(texts: list[str], chars: int = 1_000_000):
    """Runs of whole texts with about ``chars`` characters each, to bound what a batch holds."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def held_out(doc_id=None):
    """True for the rows whose crc32(doc_id as text) mod 5 is 0; they never train a model."""
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``stage`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        if path_exists(spark, folder):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)



def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[str, int]]:
    """(whole text, 0 or 1) of at most ``per_class`` rows of each label outside the held-out fold.

    The ids are chosen by hash, so that neither order nor partitioning matters; a small table of ids then
    finds its texts in one pass over the documents. A document whose id has both labels counts for both.
    """
    out = []
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(~held_out()).filter("y in (0, 1)").distinct()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for y in (0, 1):
        ids = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).select("doc_id")
        rows = docs.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(per_class)
        out += [(r.text, y) for r in rows.collect()]
    return out
