"""Data quality, exploratory tables and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions import numeric
from pitlake.operators.ordering import BUCKET_ROWS, beside, cumulative, exact_quantiles
from pitlake.operators.rules import long_form
from pitlake.session import stage


def data_quality(cases: DataFrame, approximate: bool = False) -> DataFrame:
    """One row describing a testbed case table."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return cases.agg(
        F.count(F.lit(1)).alias("n_cases"),
        distinct("judge_id").alias("n_judges"),
        distinct("comarca").alias("n_comarcas"),
        F.round(
            F.try_divide(100.0 * F.count_if(F.col("claim_value").isNull()), F.count(F.lit(1))), 2
        ).alias("pct_missing_claim_value"),
        F.round(100.0 * F.avg("unfavorable"), 2).alias("pct_unfavorable"),
        F.min("filing_date").alias("first_filing"),
        F.max("filing_date").alias("last_filing"),
        F.round(F.avg(F.datediff("decision_date", "filing_date")), 1).alias("avg_days_to_decision"),
        F.round(F.max("claim_value"), 2).alias("max_claim_value"),
    )


def quality_checks(book: DataFrame) -> DataFrame:
    """(check_name, value) with text values: one aggregate, then one row per check."""
    checks = {
        "rows": F.count(F.lit(1)),
        "distinct_case_id": F.count_distinct("case_id"),
        "missing_claim_value": F.count_if(F.col("claim_value").isNull()),
        "nonpositive_claim_value": F.count_if(F.col("claim_value") <= 0),
        "missing_filing_date": F.count_if(F.col("filing_date").isNull()),
        "decision_before_filing": F.count_if(F.col("decision_date") < F.col("filing_date")),
        "binary_label_rows": F.count_if(F.col("reformed").isNotNull()),
        "reformed_rate": F.round(F.avg("reformed"), 4),
        "first_filing_date": F.min("filing_date"),
        "last_decision_date": F.max("decision_date"),
    }
    row = book.agg(*[c.cast("string").alias(name) for name, c in checks.items()])
    return long_form(row, list(checks), "check_name", "value")


def _countable(df: DataFrame, name: str) -> Column:
    """A value in one form for each type: texts as their SHA-256, so that counting does not move them,
    floating-point numbers with one zero, all others as text."""
    value = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0)
    return F.sha2(value, 256) if isinstance(kind, T.StringType) else value.cast("string")


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column_name, dtype, missing_pct, n_unique, unique_ratio).

    Exact distinct counts go through one (column, value) aggregate, so a frequent value costs one
    row per task. ``approximate`` replaces it with sketches in a single pass.
    """
    names = df.columns
    types = F.create_map(*[F.lit(x) for n, t in df.dtypes for x in (n, t)])
    if approximate:
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(f"`{n}`").alias(f"present_{i}") for i, n in enumerate(names)],
            *[F.approx_count_distinct(f"`{n}`").alias(f"unique_{i}") for i, n in enumerate(names)],
        )
        per_column = row.select(
            "rows",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(n).alias("column_name"),
                            F.col(f"present_{i}").alias("present"),
                            F.col(f"unique_{i}").alias("n_unique"),
                        )
                        for i, n in enumerate(names)
                    ]
                )
            ),
        )
    else:
        pairs = df.select(
            F.inline(
                F.array(*[F.struct(F.lit(n).alias("column_name"), _countable(df, n).alias("value")) for n in names])
            )
        )
        per_column = (
            pairs.groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column_name")
            .agg(
                F.sum("n").alias("rows"),
                F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("present"),
                F.count("value").alias("n_unique"),
            )
        )
    return per_column.select(
        "column_name",
        types[F.col("column_name")].alias("dtype"),
        F.round(F.try_divide(100.0 * (F.col("rows") - F.col("present")), F.col("rows")), 2).alias(
            "missing_pct"
        ),
        "n_unique",
        F.round(F.try_divide("n_unique", "rows"), 4).alias("unique_ratio"),
    )


def id_like_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns in which (almost) every row has its own value: identifiers, never features.

    A sketch pass settles the clear columns; only those near the threshold are counted exactly.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.approx_count_distinct(f"`{n}`").alias(f"u{i}") for i, n in enumerate(df.columns)],
    ).first()
    rows = max(row["rows"], 1)
    ratios = {n: row[f"u{i}"] / rows for i, n in enumerate(df.columns)}
    # The band is seven standard errors of the sketch (5 %) on either side.
    sure = [n for n, r in ratios.items() if r >= threshold * 1.35]
    close = [n for n, r in ratios.items() if threshold * 0.65 <= r < threshold * 1.35]
    result = df.sparkSession.createDataFrame([(n,) for n in sure], "column_name string")
    if close:
        exact = column_profile(df.select(*[f"`{n}`" for n in close]))
        result = result.unionByName(
            exact.filter(F.col("n_unique") >= threshold * rows).select("column_name")
        )
    return result


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with missing values, or the single row ('none', 0)."""
    row = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in df.columns])
    found = long_form(row, df.columns, "column_name", "missing").filter("missing > 0")
    nothing = row.filter(" AND ".join(f"`{n}` = 0" for n in df.columns)).select(
        F.lit("none").alias("column_name"), F.lit(0).cast("bigint").alias("missing")
    )
    return found.unionByName(nothing)


def target_summary(df: DataFrame, value: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(statistic, raw, log1p) for mean, median, std, skew, p99, max, to three decimals."""
    v = F.col(value).cast("double")
    moments = df.agg(
        *[
            f(x).alias(f"{name}_{scale}")
            for scale, x in (("raw", v), ("log1p", F.log1p(v)))
            for name, f in (
                ("mean", F.avg),
                ("std", F.stddev_samp),
                ("skew", numeric.adjusted_skewness),
                ("max", F.max),
            )
        ]
    )
    order = exact_quantiles(
        df.filter(F.col(value).isNotNull()),
        value,
        {"median_raw": 0.5, "p99_raw": 0.99, "median_log1p": 0.5, "p99_log1p": 0.99},
        transform={"median_log1p": F.log1p, "p99_log1p": F.log1p},
        bucket_rows=bucket_rows,
    )
    names = ["mean", "median", "std", "skew", "p99", "max"]
    both = beside(moments, order)
    return both.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("statistic"),
                        F.round(f"{n}_raw", 3).alias("raw"),
                        F.round(f"{n}_log1p", 3).alias("log1p"),
                    )
                    for n in names
                ]
            )
        )
    )


def value_summary(df: DataFrame, value: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(statistic, value): count (rows), mean, median, p95, max, missing, to two decimals."""
    totals = df.agg(
        F.count(F.lit(1)).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.max(value).cast("double").alias("max"),
        F.count_if(F.col(value).isNull()).cast("double").alias("missing"),
    )
    order = exact_quantiles(df, value, {"median": 0.5, "p95": 0.95}, bucket_rows=bucket_rows)
    names = ["count", "mean", "median", "p95", "max", "missing"]
    row = beside(totals, order).select(*[F.round(n, 2).alias(n) for n in names])
    return long_form(row, names, "statistic", "value")


def histogram(df: DataFrame, value: Column, bins: int, lower: float, upper: float) -> DataFrame:
    """(bin, lower, upper, n) for equal-width bins; the top edge belongs to the last bin."""
    if lower == upper:
        lower, upper = lower - 0.5, upper + 0.5
    width = (upper - lower) / bins
    counts = (
        df.select(value.alias("v"))
        .filter(F.col("v").isNotNull() & F.col("v").between(lower, upper))
        .select(
            F.least(F.width_bucket("v", F.lit(lower), F.lit(upper), F.lit(bins)), F.lit(bins)).alias("bin")
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.range(1, bins + 1).select(
        F.col("id").alias("bin"),
        (lower + (F.col("id") - 1) * width).alias("lower"),
        (lower + F.col("id") * width).alias("upper"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def log_histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    edges = df.agg(F.min(F.log1p(value)).alias("lo"), F.max(F.log1p(value)).alias("hi")).first()
    if edges.lo is None:
        raise ValueError(f"{value} holds no values")
    return histogram(df, F.log1p(value), bins, edges.lo, edges.hi)


def clipped_histogram(df: DataFrame, value: str, bins: int = 50, clip: float = 0.99) -> DataFrame:
    present = df.filter(F.col(value).isNotNull())  # least() would turn a NULL into the top
    top = exact_quantiles(present, value, {"top": clip}).first().top
    if top is None:
        raise ValueError(f"{value} holds no values")
    low = present.agg(F.least(F.min(value), F.lit(top))).first()[0]
    return histogram(present, F.least(F.col(value).cast("double"), F.lit(top)), bins, low, top)


def by_group(
    df: DataFrame, by: str, value: str, label: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(by, n, median_claim, unfav_rate). Rows without a group are left out."""
    table = exact_quantiles(
        df.filter(F.col(by).isNotNull()),
        value,
        {"median": 0.5},
        [by],
        {"n": F.count(F.lit(1)), "label_sum": F.sum(label), "label_n": F.count(label)},
        bucket_rows=bucket_rows,
    )
    return table.select(
        by,
        "n",
        F.round("median", 3).alias("median_claim"),
        F.round(F.try_divide("label_sum", "label_n"), 3).alias("unfav_rate"),
    )


def monthly(df: DataFrame, value: str = "claim_value", label: str = "unfavorable") -> DataFrame:
    """(month, n_cases, unfav_rate, median_claim); months without rows are absent."""
    months = df.withColumn("month", F.trunc("filing_date", "month"))
    return by_group(months, "month", value, label).withColumnRenamed("n", "n_cases")


def quarterly(df: DataFrame, date: str = "filing_date") -> DataFrame:
    """(quarter_end, n) for every quarter between the first and the last, empty ones as 0."""
    start = F.trunc(date, "quarter").alias("quarter")
    counts = df.select(start).filter("quarter IS NOT NULL").groupBy("quarter").agg(F.count(F.lit(1)).alias("n"))
    calendar = counts.agg(F.min("quarter").alias("lo"), F.max("quarter").alias("hi")).select(
        F.explode(F.expr("sequence(lo, hi, interval 3 months)")).alias("quarter")
    )
    return calendar.join(counts, "quarter", "left").select(
        F.last_day(F.add_months("quarter", 2)).alias("quarter_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, cases, share of all rows). Missing values are not listed but count as rows."""
    total = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cases"))
    return counts.withColumn("share", F.round(F.col("cases") / total, 3))


def top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """The k most frequent values; equal counts in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cases"))
    return counts.orderBy(F.desc("cases"), column).limit(k)


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value, the missing label included."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def group_error_bars(df: DataFrame, by: str, value: Column) -> DataFrame:
    """(by, mean, sem, n) of a value; one row per group with a value."""
    return (
        df.select(by, value.alias("v"))
        .filter(F.col(by).isNotNull() & F.col("v").isNotNull())
        .groupBy(by)
        .agg(
            F.avg("v").alias("mean"),
            (F.stddev_samp("v") / F.sqrt(F.count("v"))).alias("sem"),
            F.count("v").alias("n"),
        )
    )


def missing_by_group(df: DataFrame, target: str, by: str) -> DataFrame:
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg(F.col(target).isNull().cast("double")) * 100, 2).alias("missing_pct"),
        )
    )


def variance_explained(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """(column_name, n_levels, eta_squared) of log1p(value), one scan for all groupings.

    Grouping sets give each grouping's within-group sums of squares and the grand total.
    """
    y = F.log1p(F.col(value).cast("double"))
    sets = df.select(*groups, y.alias("y")).groupingSets(
        [[F.col(g)] for g in groups] + [[]], *[F.col(g) for g in groups]
    )
    width = len(groups)
    stats = sets.agg(
        F.grouping_id(*groups).alias("gid"),
        (F.var_pop("y") * F.count("y")).alias("squares"),
    )
    # grouping_id has a 1 for each column that is not grouped, leftmost column highest.
    by_gid = F.create_map(
        *[
            F.lit(x)
            for i, g in enumerate(groups)
            for x in ((2**width - 1) ^ (1 << (width - 1 - i)), g)
        ]
    )
    present = F.coalesce(*[F.col(g).cast("string") for g in groups]) if groups else F.lit(None)
    total = stats.filter(F.col("gid") == 2**width - 1).select("squares").scalar()
    return (
        stats.filter(F.col("gid") != 2**width - 1)
        .select(by_gid[F.col("gid").cast("int")].alias("column_name"), present.alias("level"), "squares")
        .groupBy("column_name")
        .agg(
            F.count("level").alias("n_levels"),
            F.sum(F.when(F.col("level").isNotNull(), F.col("squares"))).alias("within"),
        )
        .select(
            "column_name",
            "n_levels",
            F.round(1 - F.try_divide(F.col("within"), total), 3).alias("eta_squared"),
        )
    )


def spearman(
    df: DataFrame, features: list[str], target: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(feature, spearman) over rows complete in every listed column, mean ranks for ties.

    Only the target's rank is joined to rows. For a feature, the sum of target ranks per distinct
    value is enough, so all features share one long aggregate and one ordering.
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).dropna()
    complete = stage(complete, "complete")
    ranks = cumulative(complete, [target], {"n": F.count(F.lit(1))}, bucket_rows=bucket_rows)
    centred = F.col("before_n") + (F.col("n") + 1) / 2 - (F.col("total_n") + 1) / 2
    ranked = complete.join(ranks.select(target, centred.alias("_ry")), target)
    long = ranked.select(
        "_ry",
        F.inline(
            F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in features])
        ),
    )
    measures = {
        "n": F.count(F.lit(1)),
        "ry": F.sum("_ry"),
        "ryy": F.sum(F.col("_ry") * F.col("_ry")),
    }
    table = cumulative(long, ["x"], measures, ["feature"], bucket_rows)
    rx = F.col("before_n") + (F.col("n") + 1) / 2 - (F.col("total_n") + 1) / 2
    return (
        table.groupBy("feature")
        .agg(
            F.sum(rx * F.col("ry")).alias("xy"),
            F.sum(rx * rx * F.col("n")).alias("xx"),
            F.sum("ryy").alias("yy"),
        )
        .select(
            "feature",
            F.round(F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))), 3).alias("spearman"),
        )
    )
