"""Typed readers, checked sources and reuse of prepared tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.session import path_exists, stage


CSV_OPTIONS = {"mode": "FAILFAST", "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with declared types. Columns come by name, in any order; a column the schema
    does not know is read as text, and a value of the wrong type fails the job.

    Quoted fields may hold line breaks, also where a split ends inside one. A first pass counts quotes: only
    if some line has an odd number of them are records put together from lines. Quotes inside a field must be
    doubled and the field quoted.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such table: {path}")
    header = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    header[-1:] = [c.removesuffix("\r") for c in header[-1:]]  # a file with CRLF line ends
    known = {f.name: f for f in schema.fields}
    present = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    lines = _lines(spark, path)
    if lines.filter("odd = 1").isEmpty():
        reader = spark.read.schema(present).option("header", True).option("enforceSchema", False)
        return reader.options(**CSV_OPTIONS).option("multiLine", False).csv(path)
    record = F.from_csv("record", _ddl(present), CSV_OPTIONS)
    return _records(lines).select(record.alias("r")).select("r.*")


def _ddl(layout: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in layout.fields)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, value, odd): every line with its place and whether it opens or closes a quoted field."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        (quotes % 2).alias("odd"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """(record): the text of every record after its file's header, put together from its lines.

    Each split only needs to know whether it starts inside a quoted field: the quotes of a file's earlier
    splits decide, one row a split. Then each split marks its own record starts, and a split that holds none
    before some line takes the last one of the splits before it. Only records of several lines, and the
    last of each split, are grouped; all others stay where they are.
    """
    lines = stage(lines, "lines")
    splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.groupBy("file", "split").agg(F.sum("odd").alias("n")).select(
        "file", "split", F.coalesce(F.sum("n").over(splits), F.lit(0)).alias("before")
    )
    own = Window.partitionBy("file", "split").orderBy("line")
    ahead = own.rowsBetween(Window.unboundedPreceding, -1)
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    starts = (F.col("before") + F.coalesce(F.sum("odd").over(ahead), F.lit(0))) % 2 == 0
    marked = lines.join(inside, ["file", "split"]).withColumn("starts", starts)
    marked = marked.select(
        "file",
        "split",
        "line",
        "value",
        F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True).over(so_far).alias("own"),
        (F.col("starts") & F.coalesce(F.lead("starts").over(own), F.lit(False))).alias("alone"),
    )
    marked = stage(marked, "records")
    carried = marked.groupBy("file", "split").agg(F.max("own").alias("latest")).select(
        "file", "split", F.last("latest", ignorenulls=True).over(splits).alias("carried")
    )
    heads = marked.groupBy("file").agg(F.min_by("own", F.struct("split", "line")).alias("head"))
    placed = marked.join(carried, ["file", "split"]).join(heads, "file")
    placed = placed.withColumn("start", F.coalesce("own", "carried")).filter(F.col("start") != F.col("head"))
    alone = placed.filter("alone").select(F.col("value").alias("record"))
    parts = placed.filter("NOT alone").groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("parts")
    )
    joined = parts.select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    whole = alone.unionByName(joined).select(F.regexp_replace("record", "\r$", "").alias("record"))
    return whole.filter(F.col("record") != "")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, step: str = "") -> DataFrame:
    """Parquet (or CSV by suffix); a missing table names the step that makes it."""
    if not path_exists(spark, path):
        hint = f"; run {step} first" if step else ""
        raise FileNotFoundError(f"no such table: {path}{hint}")
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV table needs a declared schema")
        return read_csv(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def verify_checksum(spark: SparkSession, path: str, expected: str) -> None:
    """Fail before any parsing unless the file's SHA-256 is the pinned one.

    A digest is one stream by nature. The bytes go through it in small blocks inside the JVM, so a file of
    any size takes constant memory.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.globStatus(root) or []:
        digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
        sink = jvm.java.security.DigestOutputStream(jvm.java.io.OutputStream.nullOutputStream(), digest)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(files.open(status.getPath()), sink, 1 << 16, True)
        found.append(bytes(digest.digest()).hex())
    if found != [expected]:
        raise ValueError(f"source checksum mismatch: expected {expected}, got {found}")


def prepared_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    validate: Callable[[DataFrame], None],
    force: bool = False,
) -> tuple[DataFrame, bool]:
    """(table, whether it was reused). A reused table is validated again; ``force`` rebuilds it."""
    if path_exists(spark, path) and not force:
        cached = spark.read.parquet(path)
        validate(cached)
        return cached, True
    from pitlake.sources.writers import publish

    return publish(build(), path, validate), False


def provenance(
    raw: DataFrame, prepared: DataFrame, label: str, source: str, checksum: str | None
) -> dict:
    """Where a table came from and how its row counts reconcile."""
    counts = prepared.agg(F.count(F.lit(1)).alias("rows"), F.count(label).alias("modelling")).first()
    record = {
        "source": source,
        "source_sha256": checksum,
        "rows_raw": raw.count(),
        "rows_prepared": counts["rows"],
        "rows_modelling": counts["modelling"],
        "columns": prepared.columns,
        "retrieved_at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
    }
    if not record["rows_modelling"] <= record["rows_prepared"] <= record["rows_raw"]:
        raise ValueError(f"row counts do not reconcile: {record}")
    return record


def read_record(spark: SparkSession, path: str, fallback: str | None = None) -> dict:
    """A JSON record, or the one at ``fallback``."""
    for candidate in filter(None, (path, fallback)):
        if path_exists(spark, candidate):
            return json.loads("\n".join(r[0] for r in spark.read.text(candidate).collect()))
    raise FileNotFoundError(f"no such record: {path}")
