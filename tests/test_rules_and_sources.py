import csv
import hashlib
import random

import pytest
from conftest import book_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake import schema
from pitlake.operators import privacy, profile, rules, tables
from pitlake.session import path_exists
from pitlake.sources import readers, writers


def test_good_cases_pass_and_a_negative_amount_does_not(spark, cases, tmp_path):
    path = str(tmp_path / "cases")
    writers.rebuild_table(cases, path, rules.CASE_RULES, "case_id")
    before = spark.read.parquet(path).count()
    first = cases.first()["case_id"]
    bad = cases.withColumn("claim_value", F.when(F.col("case_id") == first, -5.0).otherwise(F.col("claim_value")))
    with pytest.raises(rules.ConstraintError, match="claim_value_positive: 1"):
        writers.rebuild_table(bad, path, rules.CASE_RULES, "case_id")
    assert spark.read.parquet(path).count() == before  # the old table survives a refused load
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name]


def test_duplicates_are_refused_as_a_key_and_removed_on_load(spark, raw, cases, key):
    assert raw.count() > raw.select("process_number").distinct().count()
    open_rows = privacy.without_secret(raw)
    assert cases.count() == open_rows.select("process_number").distinct().count()
    with pytest.raises(rules.ConstraintError, match="case_id_unique"):
        rules.enforce(cases.unionByName(cases.limit(1)), rules.CASE_RULES, "case_id")


def test_unknown_outcome_is_refused(spark, raw, key):
    bad = raw.withColumn("sentence_outcome", F.lit("Desconhecido"))
    with pytest.raises(ValueError, match="Desconhecido"):
        tables.to_cases(privacy.anonymise(bad, key))


def test_null_passes_a_check_but_not_a_domain(spark):
    df = spark.createDataFrame([(None,), ("F",)], "s string")
    report = rules.constraint_report(df, [rules.in_domain("s", ("F",))]).first()
    assert report["violations"] == 0
    assert [r[0] for r in rules.unknown_values(df, "s", ("F",)).collect()] == [None]


def test_validate_book(spark, book):
    rules.validate_book(book)
    with pytest.raises(ValueError, match="missing columns"):
        rules.validate_book(book.drop("comarca"))
    with pytest.raises(rules.ConstraintError, match="case_id_prefix"):
        rules.validate_book(book.withColumn("case_id", F.concat(F.lit("X"), "case_id")))


def test_book_quality_literals(spark, book):
    checks = {r["check_name"]: r["value"] for r in profile.quality_checks(book).collect()}
    assert checks["rows"] == "40"
    assert checks["binary_label_rows"] == "36"
    assert checks["decision_before_filing"] == "0"
    balance = {r["reformed"]: r["n"] for r in profile.label_balance(book, "reformed").collect()}
    rows = book_rows()
    assert balance == {label: sum(r[8] == label for r in rows) for label in (1, 0, None)} and balance[None] == 4


CONSUMO = [
    ("10245108320208260576", "Bancários", "SAO PAULO", 1000.0, "PF-nPF", "Reformou", "Unânime", "2021-01-10", 10),
    ("10768308320208260100", "Telefonia", "CAMPINAS", 2000.0, "nPF-PF", "Não reformou", "Maioria", "2021-02-10", 20),
    ("10000000000000000001", "Bancários", "SANTOS", 3000.0, "PF-PF", "Desistência", "Unânime", "2021-03-10", 30),
]


def test_prepare_book_literals(spark):
    raw = spark.createDataFrame(CONSUMO, schema.CONSUMO_SCHEMA)
    rows = {r["comarca"]: r for r in tables.prepare_book(raw).collect()}
    assert str(rows["SAO PAULO"]["filing_date"]) == "2020-12-31"
    assert [rows[c]["reformed"] for c in ("SAO PAULO", "CAMPINAS", "SANTOS")] == [1, 0, None]
    assert all(r["case_id"].startswith("BOOK_") and len(r["case_id"]) == 21 for r in rows.values())
    with pytest.raises(ValueError, match="dec_date"):
        tables.prepare_book(raw.withColumn("dec_date", F.lit("soon")))
    with pytest.raises(ValueError, match="unmapped"):
        tables.prepare_book(raw.withColumn("dec_val", F.lit("?")))
    with pytest.raises(ValueError, match="missing columns"):
        tables.prepare_book(raw.drop("valor"))


def test_fingerprint_ignores_order_and_sees_changes(spark, book):
    same = tables.fingerprint(book.repartition(5))
    assert tables.fingerprint(book) == same and len(same) == 16
    assert tables.fingerprint(book.withColumn("case_days", F.col("case_days") + 1)) != same


def test_csv_round_trip_and_type_failure(spark, raw, tmp_path):
    path = str(tmp_path / "raw.csv")
    writers.write_table(raw.select(*reversed(raw.columns)), path, as_csv=True)
    back = readers.read_csv(spark, path, schema.RAW_SCHEMA)
    assert dict(back.dtypes)["claim_value"] == "double" and back.count() == raw.count()
    assert tables.fingerprint(back.select(*raw.columns)) == tables.fingerprint(raw)
    bad = tmp_path / "bad.csv"
    bad.write_text("claim_value,uf\nabc,MS\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_csv(spark, str(bad), schema.RAW_SCHEMA).collect()


def test_missing_table_names_the_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run prepare_book first"):
        readers.read_table(spark, str(tmp_path / "none"), step="prepare_book")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", ["60", "128m"])
def test_quoted_line_breaks_read_alike_in_any_splits(spark, tmp_path, split_bytes, ending):
    draw = random.Random(11)
    folder = tmp_path / "parts"
    folder.mkdir()
    want = []
    for part in range(2):
        rows = []
        for i in range(16):
            words = ["", "plain", 'with "quotes"', "a, b", "one\ntwo", "\n\nlong " + "x" * 90 + "\nend", 'q"\n"q', "é\n"]
            rows.append((f"{part}-{i}", draw.choice(words), draw.randint(0, 99)))
        want += rows
        with open(folder / f"{part}.csv", "w", encoding="utf-8", newline="") as out:
            table = csv.writer(out, lineterminator=ending)
            table.writerow(["k", "two\nlines", "n"])
            table.writerows(rows)
    layout = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = readers.read_csv(spark, str(folder), layout)
        assert got.columns == ["k", "two\nlines", "n"] and got.schema["n"].dataType == T.IntegerType()
        found = sorted((k, text or "", n) for k, text, n in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == sorted(want)


def test_wrong_type_beside_quoted_line_breaks_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('k,n\n"a\nb",1\nc,many\n')
    layout = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(path), layout).collect()


def test_checksum(spark, tmp_path):
    path = tmp_path / "source.bin"
    path.write_bytes(b"content")
    readers.verify_checksum(spark, str(path), hashlib.sha256(b"content").hexdigest())
    with pytest.raises(ValueError, match="mismatch"):
        readers.verify_checksum(spark, str(path), "0" * 64)


def test_prepared_table_is_reused_and_validated(spark, book, tmp_path):
    path, calls = str(tmp_path / "prepared"), []

    def build():
        calls.append(1)
        return book

    for force, reused in ((False, False), (False, True), (True, False)):
        table, was_reused = readers.prepared_or_build(spark, path, build, rules.validate_book, force)
        assert was_reused is reused and table.count() == 40
    assert len(calls) == 2
    book.withColumn("claim_value", F.lit(-1.0)).write.mode("overwrite").parquet(path)
    with pytest.raises(rules.ConstraintError):
        readers.prepared_or_build(spark, path, build, rules.validate_book)


def test_provenance_counts(spark, book, tmp_path):
    record = readers.provenance(book, book, "reformed", "somewhere", None)
    assert (record["rows_raw"], record["rows_prepared"], record["rows_modelling"]) == (40, 40, 36)
    writers.write_report(spark, record, str(tmp_path / "record"))
    assert readers.read_record(spark, str(tmp_path / "absent"), str(tmp_path / "record"))["rows_raw"] == 40
    assert path_exists(spark, str(tmp_path / "record"))


def test_keep_one_and_latest(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 5, "c")], "id int, o int, v string")
    assert {r["v"] for r in tables.keep_one(df, "id", [F.col("o")]).collect()} == {"a", "c"}
    assert {r["v"] for r in tables.latest_per_key(df, "id", [F.col("o")]).collect()} == {"b", "c"}


def test_requests(spark):
    rows = [
        ("ok", "MS", "x", "v", "J", 5, None, None, 0.5, None, None, None),
        ("bad", "MSX", "x", "v", "J", 13, None, None, 1.5, None, None, None),
    ]
    out = {r["request_id"]: r for r in rules.validate_requests(spark.createDataFrame(rows, schema.REQUEST_SCHEMA)).collect()}
    assert out["ok"]["valid"] and out["ok"]["errors"] == []
    assert out["bad"]["errors"] == ["uf_length", "filing_month_range", "judge_rate_range"]
