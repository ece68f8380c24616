"""Row constraints, key uniqueness, closed domains, and the checks that refuse a bad load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake import schema


class ConstraintError(ValueError):
    """A load was refused; the message carries rule names and counts, never values."""


@dataclass(frozen=True)
class Rule:
    """A condition every row must not fail. A NULL condition passes, as in a SQL CHECK."""

    name: str
    condition: str


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", f"{c} IS NOT NULL") for c in columns]


def in_domain(column: str, values: tuple[str, ...]) -> Rule:
    listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return Rule(f"{column}_domain", f"{column} IN ({listed})")


CASE_RULES = [
    *not_null(
        "case_id", "judge_id", "uf", "comarca", "vara", "filing_date", "decision_date",
        "sentence_outcome", "unfavorable",
    ),
    Rule("uf_length", "length(uf) = 2"),
    Rule("claim_value_positive", "claim_value > 0"),
    Rule("unfavorable_binary", "unfavorable IN (0, 1)"),
    Rule("decision_not_before_filing", "decision_date >= filing_date"),
]

BOOK_RULES = [
    *not_null(
        "case_id", "assunto", "comarca", "tipo_litigio", "filing_date", "decision_date",
        "claim_value", "decision_outcome", "unanimity", "case_days",
    ),
    in_domain("tipo_litigio", schema.LITIGATION_TYPES),
    Rule("claim_value_positive", "claim_value > 0"),
    Rule("reformed_binary", "reformed IN (0, 1)"),
    Rule("case_days_not_negative", "case_days >= 0"),
    Rule("decision_not_before_filing", "decision_date >= filing_date"),
]


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...], what: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


def violation_counts(rules: list[Rule]) -> list[Column]:
    return [F.count_if(~F.expr(r.condition)).alias(r.name) for r in rules]


def long_form(row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One row per named column of a one-row frame."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) AS ({label}, {value})")


def constraint_report(df: DataFrame, rules: list[Rule], key: str | None = None) -> DataFrame:
    """(rule, violations) from one aggregate, and one row for repeated keys if asked."""
    names = [r.name for r in rules]
    report = long_form(df.agg(*violation_counts(rules)), names, "rule", "violations")
    if key is not None:
        repeated = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(
            repeated.select(F.lit(f"{key}_unique").alias("rule"), "violations")
        )
    return report


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unknown_values(df: DataFrame, column: str, domain: tuple[str, ...]) -> DataFrame:
    """Distinct values outside the domain; NULL is outside every domain."""
    known = F.coalesce(F.col(column).isin(*domain), F.lit(False))
    return df.filter(~known).select(column).distinct()


def require_domain(df: DataFrame, column: str, domain: tuple[str, ...]) -> None:
    """Raise if anything is unmapped; the message lists every such value once."""
    unknown = unknown_values(df, column, domain).orderBy(column).collect()
    if unknown:
        raise ValueError(f"unmapped {column} values: {[r[0] for r in unknown]}")


def enforce(df: DataFrame, rules: list[Rule], key: str | None = None) -> None:
    failed = constraint_report(df, rules, key).filter("violations > 0").orderBy("rule").collect()
    if failed:
        raise ConstraintError("; ".join(f"{r.rule}: {r.violations}" for r in failed))


def outcome_domain() -> tuple[str, ...]:
    return schema.REFORMED_OUTCOMES + schema.NOT_REFORMED_OUTCOMES + schema.PROCEDURAL_OUTCOMES


def validate_book(df: DataFrame) -> None:
    """Composite check of a prepared book table; returns nothing when all is well."""
    require_columns(df, schema.BOOK_SCHEMA.names, "book table")
    rules = [
        *BOOK_RULES,
        Rule("case_id_prefix", "case_id LIKE 'BOOK\\_%'"),
        in_domain("decision_outcome", outcome_domain()),
    ]
    enforce(df, rules, key="case_id")


# Limits of a scoring request.
REQUEST_CHECKS = {
    "uf_length": "uf IS NULL OR length(uf) <> 2",
    "comarca_length": "comarca IS NULL OR length(comarca) > 80",
    "vara_length": "vara IS NULL OR length(vara) > 80",
    "judge_id_length": "judge_id IS NULL OR length(judge_id) > 40",
    "filing_month_range": "filing_month IS NULL OR filing_month NOT BETWEEN 1 AND 12",
    "judge_rate_range": "judge_unfav_rate_prior NOT BETWEEN 0 AND 1",
    "comarca_rate_range": "comarca_unfav_rate_prior NOT BETWEEN 0 AND 1",
}


def request_errors(checks: dict[str, str] = REQUEST_CHECKS) -> Column:
    """Names of the failed checks, in order; an absent optional value fails nothing."""
    failed = [F.when(F.expr(sql), F.lit(name)) for name, sql in checks.items()]
    return F.array_compact(F.array(*failed))


def validate_requests(df: DataFrame) -> DataFrame:
    """Row-wise, so it works on a batch and on a stream."""
    return df.withColumn("errors", request_errors()).withColumn("valid", F.size("errors") == 0)
