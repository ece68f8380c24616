"""Case tables derived from order-like source tables.

An order is filed on its order date and decided by its first shipment that is not earlier; orders
without one are undecided and stay out. The derived table is written once per application and
source folder, so each report reads a narrow columnar table instead of repeating the large join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.session import path_exists, spread, stage, table_state, tune

MISSING_VALUE_EVERY = 33
SECRET_EVERY = 97
DUPLICATE_EVERY = 100

_SOURCES = ("orders", "lineitem", "customer", "nation", "region")
_written: dict[tuple, tuple[str, DataFrame]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of long texts: matching them is heavy, so few splits are spread first."""
    return spread(table(spark, folder, name))


def derive_cases(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.to_date("o_orderdate").alias("filing_date"),
    )
    shipments = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("shipped")
    )
    # Orders are read and moved once: their columns ride along and are folded with the lines. The
    # fold follows the join on the same key, so it needs no further exchange.
    decided = (
        shipments.join(orders, "o_orderkey")
        .filter("shipped >= filing_date")
        .groupBy("o_orderkey")
        .agg(
            F.min("shipped").alias("decision_date"),
            *[F.any_value(c).alias(c) for c in orders.columns if c != "o_orderkey"],
        )
    )
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    status = F.col("o_orderstatus")
    return (
        decided.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("case_id"),
            F.col("o_custkey").alias("judge_id"),
            F.substring("r_name", 1, 2).alias("uf"),
            F.col("n_name").alias("comarca"),
            F.col("c_mktsegment").alias("vara"),
            "filing_date",
            "decision_date",
            F.col("o_totalprice").alias("amount"),
            F.when(F.col("o_orderkey") % MISSING_VALUE_EVERY != 0, F.col("o_totalprice")).alias(
                "claim_value"
            ),
            status.alias("sentence_outcome"),
            (status == "F").cast("int").alias("unfavorable"),
            F.when(status == "F", 1).when(status == "O", 0).alias("reformed"),
            F.col("o_orderpriority").alias("assunto"),
            F.col("c_name").alias("judge_name"),
            (F.col("o_orderkey") % SECRET_EVERY == 0).alias("segredo_justica"),
        )
    )


def source_state(spark: SparkSession, folder: str) -> tuple:
    """Key of anything derived from the case tables: another state of their files is another key."""
    files = table_state(spark, *(f"{folder}/{name}.parquet" for name in _SOURCES))
    return (spark.sparkContext.applicationId, files)


def _all_cases(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    memo = source_state(spark, folder)
    if memo in _written:
        path, cases = _written[memo]
        if path_exists(spark, path):
            return cases
    cases = stage(derive_cases(spark, str(folder)), "cases")
    path = cases.inputFiles()[0].rsplit("/", 1)[0]
    _written[memo] = (path, cases)
    return cases


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """The testbed track: missing amounts are present, the label is always known."""
    return _all_cases(spark, folder).select(
        "case_id",
        "judge_id",
        "uf",
        "comarca",
        "vara",
        "filing_date",
        "decision_date",
        "claim_value",
        "sentence_outcome",
        "unfavorable",
        "judge_name",
        "segredo_justica",
    )


def book_cases(spark: SparkSession, folder: str) -> DataFrame:
    """The book track: complete amounts, a three-way label."""
    return _all_cases(spark, folder).select(
        "case_id",
        "assunto",
        "comarca",
        F.col("vara").alias("tipo_litigio"),
        "filing_date",
        "decision_date",
        F.col("amount").alias("claim_value"),
        F.col("sentence_outcome").alias("decision_outcome"),
        "reformed",
        F.datediff("decision_date", "filing_date").alias("case_days"),
    )


def cases_with_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """``cases`` plus a later copy of every hundredth one, told apart by ``load_order``."""
    first = cases(spark, folder)
    copies = first.filter(F.col("case_id") % DUPLICATE_EVERY == 0)
    return first.withColumn("load_order", F.lit(0)).unionByName(
        copies.withColumn("claim_value", F.col("claim_value") + 1).withColumn("load_order", F.lit(1))
    )
