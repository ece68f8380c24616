"""Global positions, ranks and exact quantiles without a single-task sort.

All of them start from one table: distinct values with counts, in order, each with the totals of
everything before it. Counting distinct values first collapses a hot value on the map side. If the
distinct table is large it is range-partitioned into buckets of bounded size, so neither a hot
group nor the whole column ever sits in one task; bucket totals give each bucket its offset.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.session import stage

BUCKET_ROWS = 2_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL. Only the left side's keys remain."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(other, condition, how).drop(*[f"_right_{k}" for k in keys])


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to ``df`` as a scalar subquery, with no join."""
    row = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("_row", row).select("*", "_row.*").drop("_row")


def cumulative(
    df: DataFrame,
    order: list[str],
    measures: dict[str, Column],
    keys: list[str] | tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per (keys, order) with each measure, ``before_<m>`` and ``total_<m>``.

    ``measures`` are aggregate columns that add up over rows (counts and sums).
    """
    keys = list(keys)
    names = list(measures)
    distinct = df.groupBy(*keys, *order).agg(*[c.alias(m) for m, c in measures.items()])
    table = stage(distinct, "ordered")
    rows = table.count()
    if rows <= bucket_rows:
        group = Window.partitionBy(*keys, "_bucket")
        ahead = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return (
            table.withColumn("_bucket", F.lit(0))
            .select(
                "*",
                *[F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"before_{m}") for m in names],
                *[F.sum(m).over(group).alias(f"total_{m}") for m in names],
            )
            .drop("_bucket")
        )

    # Bucket ids are written down, so later passes cannot see different range boundaries.
    parts = max(2, math.ceil(rows / bucket_rows))
    ranged = stage(
        table.repartitionByRange(parts, *keys, *order).withColumn("_bucket", F.spark_partition_id()),
        "ranged",
    )
    # At most one row per bucket and key that occurs in it.
    subtotal = ranged.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_sum_{m}") for m in names])
    across = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = across.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = subtotal.select(
        *keys,
        F.col("_bucket"),
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_off_{m}") for m in names],
        *[F.sum(f"_sum_{m}").over(across).alias(f"total_{m}") for m in names],
    )
    group = Window.partitionBy(*keys, "_bucket")
    ahead = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.select(
        "*", *[F.coalesce(F.sum(m).over(ahead), F.lit(0)).alias(f"_in_{m}") for m in names]
    )
    return null_safe_join(running, offsets, [*keys, "_bucket"]).select(
        *keys,
        *order,
        *names,
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"before_{m}") for m in names],
        *[f"total_{m}" for m in names],
    )


def mid_rank(count: str = "n") -> Column:
    """Average rank of a run of ties, 1-based, over a ``cumulative`` table."""
    return F.col(f"before_{count}") + (F.col(count) + 1) / 2


def _at_quantile(value: Column, p: float, count: str) -> Column:
    """Linear interpolation between the two order statistics around ``p * (n - 1)``."""
    position = F.lit(p) * (F.col(f"total_{count}") - 1)
    start = F.col(f"before_{count}")
    end = start + F.col(count)
    low, high = F.floor(position), F.ceil(position)
    low_value = F.max(F.when((start <= low) & (low < end), value))
    high_value = F.max(F.when((start <= high) & (high < end), value))
    weight = F.max(position - low)
    return low_value + (high_value - low_value) * weight


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    keys: list[str] | tuple[str, ...] = (),
    totals: dict[str, Column] | None = None,
    transform=None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group, and group totals from the same pass.

    ``quantiles`` maps output names to probabilities, ``totals`` output names to additive
    aggregates over all rows of the group (also those whose value is NULL). ``transform`` maps
    output names to a monotone function applied to the order statistics before interpolation.
    """
    totals = totals or {}
    table = cumulative(df, [value], {"_q": F.count(value), **totals}, keys, bucket_rows)
    return quantiles_of(table, value, quantiles, keys, "_q", list(totals), transform)


def quantiles_of(
    table: DataFrame,
    value: str,
    quantiles: dict[str, float],
    keys: list[str] | tuple[str, ...],
    count: str,
    totals: list[str] | tuple[str, ...] = (),
    transform=None,
) -> DataFrame:
    """Quantiles per group from a ``cumulative`` table whose measure ``count`` counts values."""
    transform = transform or {}
    picked = [
        _at_quantile(transform.get(name, lambda c: c)(F.col(value)), p, count).alias(name)
        for name, p in quantiles.items()
    ]
    return table.groupBy(*keys).agg(*picked, *[F.sum(name).alias(name) for name in totals])
