import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitlake import schema
from pitlake.operators import history, models, privacy
from pitlake.streaming import gate, incremental


def stream_of(spark, df, folder, files=3):
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_equals_batch_and_drops_repeats(spark, raw, key, tmp_path):
    timed = raw.withColumn("received", F.timestamp_seconds(F.lit(1_700_000_000)))
    stream = stream_of(spark, timed, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    gate.run_available(gate.write_gated(gate.gate_stream(stream, key, "received"), out, str(tmp_path / "cp"), "case_id", "received"))
    got = gate.read_batches(spark, out).drop("received")
    want = privacy.anonymise(raw, key).distinct()
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_stream_stops_before_writing_an_identifier(spark, raw, key, tmp_path):
    leaky = raw.withColumn("uf", F.lit("x@y.com")).withColumn("received", F.timestamp_seconds(F.lit(1_700_000_000)))
    stream = stream_of(spark, leaky, str(tmp_path / "in"), 1)
    with pytest.raises(Exception, match="identifier patterns"):
        gate.run_available(gate.write_gated(gate.gate_stream(stream, key, "received"), str(tmp_path / "out"), str(tmp_path / "cp"), "case_id", "received"))
    assert not (tmp_path / "out").exists()


def test_scored_stream_equals_batch(spark, cases, tmp_path):
    abt = history.feature_table(cases, schema.TESTBED)
    grid = {"maxDepth": 3}
    model = models.fit_model(
        abt.filter("claim_value IS NOT NULL"), schema.TESTBED, "regression", "decision_tree",
        models.candidates("regression")["decision_tree"], grid,
    )
    names = [f.name for f in schema.REQUEST_SCHEMA.fields if f.name != "request_id"]
    requests = abt.select(F.col("case_id").alias("request_id"), *names).withColumn(
        "filing_month", F.when(F.col("judge_n_prior") == 0, 13).otherwise(F.col("filing_month"))
    )
    stream = stream_of(spark, requests, str(tmp_path / "in"))
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    gate.run_available(gate.write_scored(model, stream, out, rejects, str(tmp_path / "cp")))
    good = requests.filter("filing_month <= 12")
    got = {r["request_id"]: r["predicted_claim_value"] for r in gate.read_batches(spark, out).collect()}
    want = {r["request_id"]: round(r["prediction"], 2) for r in model.predict(good).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=0.011) for k in want)
    bad = gate.read_batches(spark, rejects)
    assert bad.count() == requests.count() - good.count() > 0
    assert {tuple(r[0]) for r in bad.select("errors").distinct().collect()} == {("filing_month_range",)}


def test_upserts_equal_a_full_rebuild(spark, cases, tmp_path):
    path = str(tmp_path / "table")
    first = cases.filter("hash(case_id) % 3 <> 0").withColumn("loaded_at", F.lit(1))
    incremental.upsert(spark, path, first, "case_id", "loaded_at")
    mark = incremental.high_water_mark(incremental.read_loaded(spark, path), "loaded_at")
    late = cases.filter("hash(case_id) % 3 = 0 OR hash(case_id) % 5 = 0").withColumn("loaded_at", F.lit(2))
    late = late.withColumn("decision_date", F.date_add("decision_date", 10))
    moved = late.withColumn("filing_date", F.date_sub("filing_date", F.when(F.expr("hash(case_id) % 2 = 0"), 40).otherwise(0)))
    feed = moved.unionByName(first)
    news = incremental.newer_than(feed, "loaded_at", mark)
    assert news.count() == moved.count()
    got = incremental.upsert(spark, path, news, "case_id", "loaded_at").drop(incremental.PART)
    want = first.join(moved.select("case_id"), "case_id", "left_anti").unionByName(moved, allowMissingColumns=True)
    assert got.count() == want.count() == got.select("case_id").distinct().count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    again = incremental.upsert(spark, path, news, "case_id", "loaded_at").drop(incremental.PART)
    assert again.select(*want.columns).exceptAll(want).count() == 0 and again.count() == want.count()


@pytest.mark.parametrize("track_name", ["testbed", "book"])
def test_refreshed_features_equal_a_rebuild(spark, cases, track_name):
    track = schema.TESTBED if track_name == "testbed" else schema.BOOK
    base = cases.withColumns(
        {
            "assunto": F.col("vara"),
            "tipo_litigio": F.col("uf"),
            "reformed": F.when(F.expr("hash(case_id) % 4 <> 0"), F.col("unfavorable")),
        }
    )
    if track is schema.BOOK:
        base = base.withColumn("claim_value", F.coalesce("claim_value", F.lit(1.0)))
    before = base.filter("hash(case_id) % 20 <> 1")
    gone = F.expr("hash(case_id) % 20 = 2")
    changed = F.expr("hash(case_id) % 20 = 3")
    after = base.filter(~gone).withColumn(
        "decision_date", F.when(changed, F.date_add("decision_date", 15)).otherwise(F.col("decision_date"))
    )
    keys = base.filter("hash(case_id) % 20 IN (1, 2, 3)").select("case_id")
    old = history.feature_table(before, track)
    got = incremental.refresh_features(old, before, after, keys, track)
    want = history.feature_table(after, track)

    def rounded(df):
        return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)])

    assert got.count() == want.count()
    assert rounded(got).exceptAll(rounded(want)).count() == 0


def test_only_overlapping_windows_are_affected(spark):
    d = dt.date
    layout = "k string, filing_date date, decision_date date"
    cases = spark.createDataFrame([("a", d(2020, 1, 10), None), ("a", d(2020, 3, 1), None), ("b", d(2020, 1, 10), None)], layout)
    changed = spark.createDataFrame([("a", None, d(2020, 1, 5))], layout)
    got = incremental.affected_days(changed, cases, "k", 30).collect()
    assert [(r["k"], r["filing_date"]) for r in got] == [("a", d(2020, 1, 10))]


def test_late_rows_are_written_once(spark, tmp_path):
    """Files in shuffled order of event time, several batches, some deliveries repeated days late."""
    rows = [(i, (i * 37) % 90) for i in range(60)]
    batches = [rows[i::4] + rows[: 5 * i] for i in range(4)]
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "case_id long, day int").selectExpr("case_id", "timestamp_seconds(86400L * day) AS received")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    gate.run_available(gate.write_gated(stream, out, str(tmp_path / "cp"), "case_id", "received"))
    got = gate.read_batches(spark, out)
    assert sorted(r.case_id for r in got.collect()) == list(range(60))
    assert len(list((tmp_path / "out").glob("query=*/batch=*"))) == 4


def deliveries(spark, folder, rows):
    """One more file of (case_id, day) rows in an input folder."""
    df = spark.createDataFrame(rows, "case_id string, day int").selectExpr("case_id", "timestamp_seconds(86400L * day) AS received")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def released(spark, folder, layout, out, checkpoint):
    stream = spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(folder)
    gate.run_available(gate.write_gated(stream, out, checkpoint, "case_id", "received"))
    return sorted(r.case_id for r in gate.read_batches(spark, out).select("case_id").collect())


def test_a_key_delivered_again_on_another_day_is_written_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    layout = deliveries(spark, folder, [("a", 1), ("b", 1)])
    assert released(spark, folder, layout, out, checkpoint) == ["a", "b"]
    deliveries(spark, folder, [("a", 5), ("c", 5), ("c", 6)])
    assert released(spark, folder, layout, out, checkpoint) == ["a", "b", "c"]  # also after a restart


def test_a_new_checkpoint_keeps_earlier_output_and_repeats_none_of_it(spark, tmp_path):
    folder, other, out = (str(tmp_path / x) for x in ("in", "other", "out"))
    layout = deliveries(spark, folder, [("a", 1), ("b", 1)])
    assert released(spark, folder, layout, out, str(tmp_path / "cp1")) == ["a", "b"]
    deliveries(spark, other, [("a", 9), ("z", 9)])
    assert released(spark, other, layout, out, str(tmp_path / "cp2")) == ["a", "b", "z"]
    deliveries(spark, folder, [("z", 2), ("y", 2)])
    assert released(spark, folder, layout, out, str(tmp_path / "cp1")) == ["a", "b", "y", "z"]
    assert len(list((tmp_path / "out").glob("query=*"))) == 2


def test_upsert_keeps_stored_rows_without_a_date(spark, tmp_path):
    layout = "case_id int, filing_date date, loaded_at int"
    path = str(tmp_path / "table")
    incremental.upsert(spark, path, spark.createDataFrame([(1, None, 1), (2, None, 1), (3, dt.date(2020, 1, 5), 1)], layout), "case_id", "loaded_at")
    got = incremental.upsert(spark, path, spark.createDataFrame([(2, None, 2), (3, None, 2)], layout), "case_id", "loaded_at")
    assert sorted((r.case_id, r.loaded_at) for r in got.collect()) == [(1, 1), (2, 2), (3, 2)]


@pytest.mark.parametrize("step", ["month folders", "manifest"])
def test_a_stopped_load_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    layout, path = "case_id int, filing_date date, loaded_at int", str(tmp_path / "table")
    day = dt.date(2020, 1, 5)
    old = [(i, day + dt.timedelta(40 * i), 1) for i in range(4)]
    incremental.upsert(spark, path, spark.createDataFrame(old, layout), "case_id", "loaded_at")
    news = spark.createDataFrame([(0, dt.date(2021, 7, 1), 2), (1, old[1][1], 2), (9, day, 2)], layout)

    def rows():
        return sorted((r.case_id, r.filing_date, r.loaded_at) for r in incremental.read_loaded(spark, path).collect())

    with monkeypatch.context() as stopped:
        if step == "manifest":
            stopped.setattr(incremental, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        else:
            stopped.setattr(incremental, "latest_per_key", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            incremental.upsert(spark, path, news, "case_id", "loaded_at")
    assert rows() == old
    incremental.upsert(spark, path, news, "case_id", "loaded_at")
    want = sorted([(0, dt.date(2021, 7, 1), 2), (1, old[1][1], 2), *old[2:], (9, day, 2)])
    assert rows() == want
    incremental.discard_superseded(spark, path)
    assert rows() == want
    with pytest.raises(RuntimeError, match="another load"):
        incremental._commit(spark, path, 2, {}, news.schema)
