"""The gate and scoring on streams. The transformations are the batch ones."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pitlake import schema
from pitlake.operators import privacy, rules, scoring
from pitlake.operators.models import FittedModel
from pitlake.session import subfolders

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def gate_stream(
    raw: DataFrame,
    key: str,
    event_time: str,
    options: privacy.GateOptions = privacy.GateOptions(),
) -> DataFrame:
    """Pseudonymised stream; ``write_gated`` leaves out repeated deliveries of a case."""
    rules.require_columns(raw, [*schema.RAW_REQUIRED, event_time], "raw stream")
    return privacy.without_secret(raw).select(event_time, *privacy.gate_columns(key, options))


def _query_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """Where the query of a checkpoint writes: its id is in the checkpoint, so a new checkpoint gets a folder of its own."""
    described = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"{path}/query={json.loads(described)['id']}"


def _write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """One folder per micro-batch: a replayed batch overwrites its own output and nothing else."""
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def _without_other_queries(batch: DataFrame, path: str, folder: str, key: str) -> DataFrame:
    """Rows whose key no query with another checkpoint has written to the same output.

    Keys of the own query are in its stream state; those of others are a finished table of one column.
    """
    spark = batch.sparkSession
    others = [f for f in subfolders(spark, path) if f"/{f.rsplit('/', 1)[1]}" != folder[len(path) :]]
    if not others:
        return batch
    written = spark.read.schema(batch.select(key).schema).parquet(*[f"{f}/batch=*" for f in others])
    return batch.join(written.filter(F.col(key).isNotNull()), key, "left_anti").select(*batch.columns)


def write_gated(stream: DataFrame, path: str, checkpoint: str, key: str, event_time: str) -> DataStreamWriter:
    """Each micro-batch passes the identifier scan before it is written; a hit stops the stream.

    Every ``key`` is written once, whenever and on whatever day it is delivered again: the query's state remembers
    all its keys (in RocksDB, by key hash, so it is neither held in memory nor bound to event time), and
    rows without a key count as one. A query with a new checkpoint over the same output leaves out what earlier ones wrote and
    touches none of their folders; at one time only one query may write to an output. ``event_time`` stays a column.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rules.require_columns(stream, [key, event_time], "gated stream")

    def release(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            privacy.assert_no_pii(batch)
            folder = _query_folder(batch.sparkSession, path, checkpoint)
            _write_batch(_without_other_queries(batch, path, folder, key), folder, batch_id)
        finally:
            batch.unpersist()

    return stream.dropDuplicates([key]).writeStream.foreachBatch(release).option("checkpointLocation", checkpoint)


def write_scored(
    model: FittedModel, requests: DataFrame, path: str, rejects: str, checkpoint: str
) -> DataStreamWriter:
    """Valid requests are scored to one sink, the others go with their errors to another."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, rejected = scoring.split_requests(batch)
            for df, base in ((scoring.score(model, valid), path), (rejected, rejects)):
                _write_batch(df, _query_folder(batch.sparkSession, base, checkpoint), batch_id)
        finally:
            batch.unpersist()

    return requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there and stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/query=*/batch=*").drop("query", "batch")
