"""What the plans must look like, and that skew changes no result."""

import datetime as dt
import random

import pytest
from oracle_check import spark_entry
from pyspark.sql import functions as F

from pitlake import schema
from pitlake.functions import ids, text
from pitlake.operators import anomaly, evaluate, history, privacy, profile, split
from pitlake.plans import casebook
from pitlake.session import spread, stage

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan(spark, cases):
    text_plan = executed(history.feature_table(cases, schema.TESTBED))
    assert "CartesianProduct" not in text_plan and "NestedLoopJoin" not in text_plan
    assert "Python" not in text_plan
    # The history side reads the five columns it needs and filters keys in the scan.
    assert "PushedFilters: [IsNotNull(judge_id)]" in text_plan
    assert text_plan.count("sentence_text") == 0


def test_cutoff_reaches_the_scan(cases):
    parts = split.temporal_split(cases, purge=True)
    text_plan = executed(parts.train.select("case_id"))
    pushed = text_plan.split("PushedFilters: ")[1]  # Spark shortens the list in plan strings
    assert "LessThan(filing_date" in pushed and "LessThan(dec" in pushed


def test_key_material_is_redacted_in_plans(spark, raw, key):
    df = raw.select(ids.pseudonym(F.col("process_number"), key, "CASE", digits=True).alias("case_id"))
    for pad in ids.key_pads(key):
        assert pad.hex().upper() not in plan(df)
    assert df.count() == raw.count()


def test_scrub_stays_in_the_jvm(spark):
    docs = casebook.table(spark, FOLDER, "documents")
    assert "Python" not in executed(docs.select(text.scrub(F.col("text")), text.has_sensitive_terms(F.col("text"))))


def test_joins_without_a_key_are_absent(spark):
    for name in ("target_summary", "value_summary", "reg_metrics", "cls_metrics", "wilcoxon_stat", "baseline_predictions"):
        assert "NestedLoopJoin" not in executed(spark_entry.queries()[name](spark, FOLDER))


def test_spread_leaves_large_and_shuffled_tables_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).coalesce(1).write.parquet(path)
    few = spark.read.parquet(path)
    tasks = spark.sparkContext.defaultParallelism
    assert "RoundRobin" in executed(spread(few)) or tasks == 1
    many = spark.range(0, 1000, 1, tasks * 2)
    assert spread(many) is many
    shuffled = few.groupBy("id").count()
    assert spread(shuffled) is shuffled


@pytest.fixture(scope="module")
def skewed(spark):
    """Two fifths of all rows share one customer, place, day and amount."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        filed = dt.date(2021, 3, 1) if hot else dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(300))
        judge = "hot" if hot else f"j{rng.randrange(60)}"
        value = 500.0 if hot else float(rng.randrange(100, 9000))
        rows.append((i, judge, "MS", "a" if hot else "b", "v", filed, filed + dt.timedelta(days=rng.randrange(5, 90)), value, rng.randrange(2)))
    layout = "case_id int, judge_id string, uf string, comarca string, vara string, filing_date date, decision_date date, claim_value double, unfavorable int"
    return stage(spark.createDataFrame(rows, layout), "skewed")


def test_skewed_history(spark, skewed):
    pdf = skewed.toPandas()
    table = history.feature_table(skewed, schema.TESTBED).toPandas().set_index("case_id")
    assert len(table) == len(pdf)
    for case in pdf.sample(60, random_state=1).itertuples():
        start = case.filing_date - dt.timedelta(days=180)
        seen = pdf[(pdf.judge_id == case.judge_id) & (pdf.decision_date < case.filing_date) & (pdf.decision_date >= start)]
        assert table.loc[case.case_id, "judge_n_prior"] == len(seen)
        if len(seen):
            assert table.loc[case.case_id, "judge_avg_value_prior"] == pytest.approx(seen.claim_value.mean())


def test_hot_key_window_sees_days_not_rows(spark, skewed):
    days = history.day_history(skewed, "judge_id", 180).filter("judge_id = 'hot'").count()
    assert days == 1 and skewed.filter("judge_id = 'hot'").count() > 500


@pytest.mark.parametrize("bucket_rows", [10**6, 100])
def test_skewed_statistics(spark, skewed, bucket_rows):
    pdf = skewed.toPandas()
    got = {r["judge_id"]: r for r in profile.by_group(skewed, "judge_id", "claim_value", "unfavorable", bucket_rows).collect()}
    want = pdf.groupby("judge_id")["claim_value"].median()
    assert {k: r["median_claim"] for k, r in got.items()} == pytest.approx(want.to_dict())
    z = anomaly.peer_z(skewed, bucket_rows=bucket_rows).filter("comarca = 'a'").select("peer_z").distinct().collect()
    assert [r[0] for r in z] == [0.0]  # the hot group is constant
    auc = evaluate.roc_auc(skewed.withColumn("p", F.col("claim_value") / 9000), "unfavorable", "p", bucket_rows=bucket_rows)
    pos, neg = pdf[pdf.unfavorable == 1].claim_value, pdf[pdf.unfavorable == 0].claim_value
    wins = sum((pos > v).sum() + 0.5 * (pos == v).sum() for v in neg)
    assert auc.first()[0] == pytest.approx(wins / (len(pos) * len(neg)))


def test_skewed_suppression_and_folds(spark, skewed):
    kept = privacy.suppress_small_groups(skewed.withColumn("sentence_outcome", F.lit("x")), 5)
    hot = skewed.filter("judge_id = 'hot'").count()
    assert kept.filter("judge_id = 'hot'").count() == hot
    sizes = {r["fold"]: r["count"] for r in split.with_time_folds(skewed).groupBy("fold").count().collect()}
    assert all(sizes[i] == 300 for i in range(1, 5))
