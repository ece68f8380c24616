import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlake.operators import ordering


def rows(spark, seed=1, n=3000):
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n))
    value = np.where(rng.random(n) < 0.3, 7.0, np.round(rng.normal(size=n) * 100, 1))
    data = [
        (i, None if g == "c" and i % 3 == 0 else str(g), None if i % 11 == 0 else float(v))
        for i, (g, v) in enumerate(zip(group, value, strict=True))
    ]
    return spark.createDataFrame(data, "id int, g string, v double")


@pytest.mark.parametrize("bucket_rows", [10**6, 50])
def test_quantiles_equal_numpy_per_group(spark, bucket_rows):
    df = rows(spark)
    pdf = df.toPandas()
    got = ordering.exact_quantiles(
        df, "v", {"lo": 0.1, "mid": 0.5, "p99": 0.99}, ["g"], {"n": F.count(F.lit(1))}, bucket_rows=bucket_rows
    ).collect()
    assert len(got) == pdf["g"].nunique(dropna=False)
    for r in got:
        part = pdf[pdf["g"].isna()] if r["g"] is None else pdf[pdf["g"] == r["g"]]
        assert r["n"] == len(part)
        for name, p in (("lo", 0.1), ("mid", 0.5), ("p99", 0.99)):
            assert r[name] == pytest.approx(np.quantile(part["v"].dropna(), p), abs=1e-9)


@pytest.mark.parametrize("bucket_rows", [10**6, 40])
def test_mid_ranks_equal_pandas(spark, bucket_rows):
    df = rows(spark, 2).filter("v IS NOT NULL")
    table = ordering.cumulative(df, ["v"], {"n": F.count(F.lit(1))}, bucket_rows=bucket_rows)
    got = {r["v"]: r["rank"] for r in table.select("v", ordering.mid_rank().alias("rank")).collect()}
    pdf = df.toPandas()
    for v, rank in zip(pdf["v"], pdf["v"].rank(), strict=True):
        assert got[v] == rank


def test_buckets_bound_every_task(spark):
    """A hot group is spread over buckets, and results do not depend on their number."""
    df = rows(spark, 3)
    tables = [
        {tuple(r) for r in ordering.cumulative(df, ["v"], {"n": F.count(F.lit(1))}, ["g"], b).collect()}
        for b in (10**6, 100, 7)
    ]
    assert tables[0] == tables[1] == tables[2]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "v double")
    assert ordering.exact_quantiles(empty, "v", {"m": 0.5}).first()["m"] is None
