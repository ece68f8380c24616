"""Incremental load and incremental features, equal to a full rebuild."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.operators import history
from pitlake.operators.tables import latest_per_key
from pitlake.schema import Track
from pitlake.session import path_exists, stage, subfolders

PART = "filing_part"
UNDATED = "undated"  # never NULL, so that a part can be compared and addressed


def with_part(df: DataFrame) -> DataFrame:
    """Filing month as the partition column; rows without a date have a part of their own."""
    return df.withColumn(PART, F.coalesce(F.date_format("filing_date", "yyyy-MM"), F.lit(UNDATED)))


def write_partitioned(df: DataFrame, path: str) -> None:
    with_part(df).write.mode("overwrite").partitionBy(PART).parquet(path)


def newer_than(df: DataFrame, loaded_at: str, mark: object | None) -> DataFrame:
    """Rows above the stored high-water mark; all rows when there is none yet."""
    return df if mark is None else df.filter(F.col(loaded_at) > F.lit(mark))


def high_water_mark(df: DataFrame, loaded_at: str) -> object | None:
    return df.agg(F.max(loaded_at)).first()[0]


MANIFESTS = "_manifests"  # Spark takes names with an underscore for no data


def _latest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and content of the newest manifest of a table; 0 and None before the first load."""
    folder = f"{path}/{MANIFESTS}"
    if not path_exists(spark, folder):
        return 0, None
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    numbers = [int(n.removesuffix(".json")) for n in (f.getPath().getName() for f in listed) if n[0].isdigit()]
    if not numbers:
        return 0, None
    text = spark.read.text(f"{folder}/{max(numbers):010d}.json", wholetext=True).first()[0]
    return max(numbers), json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, months: dict[str, str], layout: T.StructType) -> None:
    """Publish a state of the table by one rename. A state that another writer published first is an error."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    final = make(f"{path}/{MANIFESTS}/{number:010d}.json")
    draft = make(f"{path}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft)
    out.write(bytearray(json.dumps({"months": months, "layout": layout.jsonValue()}).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"{path} was changed by another load")


def _folders(spark: SparkSession, path: str, manifest: dict, months: list[str]) -> DataFrame:
    layout = T.StructType.fromJson(manifest["layout"])
    if not months:
        return spark.createDataFrame([], layout)
    folders = [f"{path}/{manifest['months'][m]}/{PART}={m}" for m in months]
    return spark.read.schema(layout).option("basePath", path).parquet(*folders).select(*layout.names)


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``upsert`` as its newest manifest states it: all of a load or nothing of it."""
    _, manifest = _latest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no such table: {path}")
    return _folders(spark, path, manifest, sorted(manifest["months"]))


def upsert(
    spark: SparkSession, path: str, incoming: DataFrame, key: str, loaded_at: str
) -> DataFrame:
    """Merge new rows into a table partitioned by filing month: the latest load of a key wins.

    Only months that hold an incoming row, or the old row of an incoming key, are written again, into a
    folder of this load. A manifest of all month folders is published last by one rename, and readers go
    by the newest one: a load that stops at any step leaves the old table, and a rerun of the same rows
    gives the same table. One load at a time may write.
    """
    fresh = stage(with_part(incoming), "incoming")
    number, manifest = _latest(spark, path)
    kept = dict(manifest["months"]) if manifest else {}
    both = fresh
    if manifest:
        current = _folders(spark, path, manifest, sorted(kept))
        keys = fresh.select(key).distinct()
        gone = current.join(keys, key, "left_semi").select(PART)
        touched = [r[0] for r in fresh.select(PART).unionByName(gone).distinct().collect()]  # one per calendar month
        old = _folders(spark, path, manifest, sorted(set(touched) & set(kept)))
        both = old.unionByName(fresh.select(*old.columns))
        kept = {m: folder for m, folder in kept.items() if m not in touched}
    merged = stage(latest_per_key(both, key, [F.col(loaded_at)]), "merged")
    load = f"load={number + 1:010d}-{uuid.uuid4().hex[:12]}"
    merged.write.partitionBy(PART).parquet(f"{path}/{load}")
    kept |= {r[0]: load for r in merged.select(PART).distinct().collect()}
    _commit(spark, path, number + 1, kept, merged.schema)
    return read_loaded(spark, path)


def discard_superseded(spark: SparkSession, path: str) -> None:
    """Delete month folders that the newest manifest does not name, once no reader of older ones is left."""
    _, manifest = _latest(spark, path)
    named = {(folder, f"{PART}={month}") for month, folder in (manifest or {"months": {}})["months"].items()}
    for load in subfolders(spark, path):
        for month in subfolders(spark, load):
            if tuple(month.rsplit("/", 2)[1:]) not in named and load.rsplit("/", 1)[1].startswith("load="):
                old = spark._jvm.org.apache.hadoop.fs.Path(month)
                old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def affected_days(changed: DataFrame, cases: DataFrame, key: str, window_days: int) -> DataFrame:
    """(key, filing_date) of every filing day whose window holds a changed decision.

    Changed decisions and filing days are folded to days first, so a hot key stays small.
    """
    days = changed.filter(F.col(key).isNotNull() & F.col("decision_date").isNotNull()).select(
        key, F.col("decision_date").alias("day"), F.lit(1).alias("hit"), F.lit(0).alias("probe")
    )
    touched = days.select(key).distinct()
    probes = (
        cases.filter(F.col("filing_date").isNotNull())
        .join(touched, key, "left_semi")
        .select(key, F.col("filing_date").alias("day"), F.lit(0).alias("hit"), F.lit(1).alias("probe"))
    )
    grid = days.unionByName(probes).groupBy(key, "day").agg(F.max("hit").alias("hit"), F.max("probe").alias("probe"))
    frame = Window.partitionBy(key).orderBy(F.unix_date("day")).rangeBetween(-window_days, -1)
    hits = grid.select(key, F.col("day").alias("filing_date"), "probe", F.max("hit").over(frame).alias("hit"))
    return hits.filter("probe = 1 AND hit = 1").select(key, "filing_date")


def refresh_features(
    features: DataFrame,
    before: DataFrame,
    after: DataFrame,
    changed_keys: DataFrame,
    track: Track,
    window_days: int | None = None,
) -> DataFrame:
    """Feature table for ``after``, reusing rows of ``features`` (built from ``before``).

    ``changed_keys`` has the ``case_id`` of every case added, changed or removed in between.
    Recomputed are those cases and the cases with a changed decision, old or new, inside one of
    their windows. A late ruling is keyed by its decision date like any other.
    """
    window = track.window_days if window_days is None else window_days
    columns = ["case_id", *track.dimensions, "filing_date", "decision_date", "claim_value", track.label]
    columns = list(dict.fromkeys(columns))
    old, new = before.select(*columns), after.select(*columns)
    keys = changed_keys.select("case_id").distinct()
    added, removed = (d.join(keys, "case_id", "left_semi").select(*columns) for d in (new, old))
    changed = stage(added.unionByName(removed), "changed")

    def is_hit(key: str) -> DataFrame:
        days = affected_days(changed, new, key, window)
        return new.join(days, [key, "filing_date"], "left_semi").select("case_id")

    stale = [is_hit(key) for key, _ in track.grains]
    ids = stage(
        reduce(DataFrame.unionByName, [keys, *stale]).distinct(), "affected"
    )
    todo = new.join(ids, "case_id", "left_semi")
    if track.labelled_only:
        new, todo = (d.filter(F.col(track.label).isNotNull()) for d in (new, todo))
    todo = stage(todo, "todo")
    span = todo.agg(F.min("filing_date").alias("first"), F.max("filing_date").alias("last")).first()
    keep = features.join(ids, "case_id", "left_anti").select(*features.columns)
    if span["first"] is None:
        return keep
    # Only decisions that a recomputed case can see; the dates reach the scan as literals.
    visible: Column = (F.col("decision_date") < F.lit(span["last"])) & (
        F.col("decision_date") >= F.date_sub(F.lit(span["first"]), window)
    )
    table = todo
    for key, prefix in track.grains:
        keys = todo.select(key).distinct()
        events = new.filter(visible).join(keys, key, "left_semi")
        # Probe days come from the cases to recompute, events from the visible history.
        source = events.select(*columns).unionByName(
            todo.select(*columns).withColumn("decision_date", F.lit(None).cast("date"))
        )
        table = history.attach_history(
            table, source, key, prefix, track.rate_name, window, track.label, track.empty_history
        )
    return keep.unionByName(history.with_calendar(table, track).select(*features.columns))
