"""Splits by time: the past trains, the future tests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.operators.ordering import BUCKET_ROWS, cumulative


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame
    cutoff: dt.date


def _day_positions(df: DataFrame, date: str) -> DataFrame:
    """Rows before each day. The window holds one row per calendar day, never the rows."""
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return days.select(
        date,
        "n",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )


def cutoff_date(df: DataFrame, test_fraction: float = 0.2, date: str = "filing_date") -> dt.date:
    """The date at sorted position ``int(n * (1 - test_fraction))``."""
    position = F.floor(F.col("total") * F.lit(1 - test_fraction))
    found = _day_positions(df, date).filter(
        (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
    )
    row = found.first()
    if row is None:
        raise ValueError("no row at the split position; is the table empty?")
    return row[date]


def temporal_split(
    df: DataFrame,
    test_fraction: float = 0.2,
    purge: bool = False,
    date: str = "filing_date",
    known: str = "decision_date",
) -> Split:
    """Train before the cutoff, test from it on; all rows of the cutoff day are test rows.

    ``purge`` also drops training rows whose label was not yet known at the cutoff. The cutoff
    becomes a literal, so both sides are plain filters that reach the scan.
    """
    cutoff = cutoff_date(df, test_fraction, date)
    train = df.filter(F.col(date) < F.lit(cutoff))
    if purge:
        train = train.filter(F.col(known) < F.lit(cutoff))
    return Split(train, df.filter(F.col(date) >= F.lit(cutoff)), cutoff)


def boundaries(
    df: DataFrame,
    positions: list[int],
    date: str = "filing_date",
    key: str = "case_id",
    bucket_rows: int = BUCKET_ROWS,
) -> list[tuple]:
    """(date, key) at each position of the order by date and key.

    The day is found from day counts; only rows of the days that hold a boundary are ordered by key.
    """
    days = _day_positions(df, date)
    wanted = F.lit(False)
    for p in positions:
        wanted = wanted | ((F.col("before") <= p) & (p < F.col("before") + F.col("n")))
    hits = {r[date]: r["before"] for r in days.filter(wanted).collect()}
    on_days = df.filter(F.col(date).isin(list(hits)))
    order = cumulative(on_days, [key], {"n": F.count(F.lit(1))}, [date], bucket_rows)
    found = F.lit(False)
    for day, before in hits.items():
        inside = [p - before for p in positions if p >= before]
        found = found | (
            (F.col(date) == F.lit(day)) & F.array_contains(F.array(*[F.lit(i).cast("bigint") for i in inside]), F.col("before_n").cast("bigint"))
        )
    rows = order.filter(found).collect()
    at = {hits[r[date]] + r["before_n"]: (r[date], r[key]) for r in rows}
    if missing := [p for p in positions if p not in at]:
        raise ValueError(f"no single {key} stands at positions {missing}: it repeats on a boundary day")
    return [at[p] for p in positions]


def from_boundary(boundary: tuple, date: str = "filing_date", key: str = "case_id") -> Column:
    """Whether a row stands at or after a boundary in the (date, key) order."""
    day, value = boundary
    return (F.col(date) > F.lit(day)) | ((F.col(date) == F.lit(day)) & (F.col(key) >= F.lit(value)))


def with_time_folds(
    df: DataFrame, splits: int = 4, date: str = "filing_date", key: str = "case_id"
) -> DataFrame:
    """Add ``fold``: fold i tests the rows marked i and trains on every row marked less.

    The blocks are equal in size, the remainder stays in block 0. Assigning a row compares it with
    a few literals, so nothing is sorted or shuffled.
    """
    rows = df.count()
    size = rows // (splits + 1)
    if size == 0:
        raise ValueError(f"{rows} rows are too few for {splits} folds")
    starts = [rows - (splits - i) * size for i in range(splits)]
    fold = F.lit(0)
    for boundary in boundaries(df, starts, date, key):
        fold = fold + from_boundary(boundary, date, key).cast("int")
    return df.withColumn("fold", fold)


def fit_validation_split(
    df: DataFrame, fraction: float = 0.15, date: str = "filing_date", key: str = "case_id"
) -> tuple[DataFrame, DataFrame]:
    """The last ``fraction`` of rows by time, cut by position, as validation rows."""
    start = int(df.count() * (1 - fraction))
    later = from_boundary(boundaries(df, [start], date, key)[0], date, key)
    return df.filter(~later), df.filter(later)


def deterministic_sample(df: DataFrame, k: int, key: str = "case_id", seed: int = 42) -> DataFrame:
    """Exactly min(n, k) rows, the same whatever the partitioning."""
    draw = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    return df.orderBy(draw, key).limit(k)
