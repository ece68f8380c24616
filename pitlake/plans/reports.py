"""Reports over the source tables: one function per operator, each over whole tables."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlake import schema
from pitlake.functions import ids, numeric, text
from pitlake.operators import (
    anomaly,
    attribution,
    encode,
    evaluate,
    history,
    models,
    privacy,
    profile,
    rules,
    scoring,
    split,
    tables,
)
from pitlake.operators.ordering import beside, cumulative
from pitlake.plans import casebook
from pitlake.session import stage, work_folder
from pitlake.streaming import gate, incremental

# Key for pseudonyms over generated customer names. Real jobs take theirs as a parameter.
DEMO_KEY = "demonstration-key-for-generated-tables"
NUMERIC = ["filing_month", "n_prior", "avg_value_prior", "label_rate_prior"]


def _whole_cents(df: DataFrame) -> DataFrame:
    """Amounts as whole cents, so that sums over any partitioning are exact."""
    return df.withColumn("claim_value", F.round(F.col("claim_value") * 100).cast("bigint"))


def _in_currency(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c) / 100 for c in columns})


def _one_grain(spark: SparkSession, folder: str, key: str, window: int) -> DataFrame:
    base = _whole_cents(casebook.cases(spark, folder)).select(
        "case_id", key, "filing_date", "decision_date", "claim_value", "unfavorable"
    )
    table = history.attach_history(base, base, key, "h", "rate", window, "unfavorable")
    return table.select(
        "case_id",
        F.month("filing_date").alias("filing_month"),
        F.col("h_n_prior").alias("n_prior"),
        (F.col("h_avg_value_prior") / 100).alias("avg_value_prior"),
        F.col("h_rate").alias("label_rate_prior"),
    )


def abt_comarca_180(spark, folder):
    return _one_grain(spark, folder, "comarca", 180)


def abt_customer_180(spark, folder):
    return _one_grain(spark, folder, "judge_id", 180)


def abt_full(spark, folder):
    table = history.feature_table(_whole_cents(casebook.cases(spark, folder)), schema.TESTBED)
    return _in_currency(table, "claim_value", "judge_avg_value_prior", "comarca_avg_value_prior")


def abt_book_365(spark, folder):
    table = history.feature_table(_whole_cents(casebook.book_cases(spark, folder)), schema.BOOK)
    table = _in_currency(table, "claim_value", "comarca_avg_value_prior", "assunto_avg_value_prior")
    return table.withColumn("claim_value_log", F.round(F.log1p("claim_value"), 6))


def dq_profile(spark, folder):
    return profile.data_quality(casebook.cases(spark, folder))


def dq_checks(spark, folder):
    return profile.quality_checks(casebook.book_cases(spark, folder))


def constraint_report(spark, folder):
    return rules.constraint_report(casebook.cases(spark, folder), rules.CASE_RULES, "case_id")


def book_rules(spark, folder):
    """The row rules of the second track; its litigation types here are market segments, so that rule always fails."""
    table = casebook.book_cases(spark, folder).withColumn("unanimity", F.lit("unknown"))
    return rules.constraint_report(table, rules.BOOK_RULES, "case_id")


def domain_values(spark, folder):
    """The sorted distinct values of each category column, in one text."""
    columns = ("uf", "vara", "sentence_outcome")
    row = casebook.cases(spark, folder).agg(*[F.array_join(F.sort_array(F.collect_set(c)), ",").alias(c) for c in columns])
    return rules.long_form(row, list(columns), "column_name", "known_values")


def unknown_domain(spark, folder):
    return rules.unknown_values(casebook.cases(spark, folder), "sentence_outcome", ("F", "O"))


def dedupe_keep_first(spark, folder):
    rows = casebook.cases_with_duplicates(spark, folder)
    first = tables.keep_one(rows, "case_id", [F.col("load_order")])
    return first.select("case_id", "judge_id", "filing_date", "claim_value", "load_order")


def dedupe_keep_latest(spark, folder):
    rows = casebook.cases_with_duplicates(spark, folder)
    last = tables.latest_per_key(rows, "case_id", [F.col("load_order")])
    return last.select("case_id", "judge_id", "filing_date", "claim_value", "load_order")


def pseudonyms(spark, folder):
    return casebook.cases(spark, folder).select(
        "case_id",
        ids.pseudonym(F.col("judge_name"), DEMO_KEY, "JUDGE").alias("judge_pseudonym"),
        ids.pseudonym(F.col("judge_name"), DEMO_KEY, "CASE", digits=True).alias("number_pseudonym"),
    )


def gate_release(spark, folder):
    """The whole gate over cases given accented names, numbers and texts; released only if the scan finds nothing."""
    case = F.col("case_id").cast("string")
    raw = casebook.cases(spark, folder).select(
        F.lpad(case, 20, "0").alias("process_number"),
        F.lpad(F.pmod(F.col("case_id"), F.lit(10**11)).cast("string"), 11, "0").alias("cpf"),
        F.concat(F.lit("José "), "vara").alias("party_name"),
        F.concat(F.translate("judge_name", "Cuo", "Çúô"), F.lit(" Sa\u0303o  Paulo")).alias("judge_name"),
        "uf", "comarca", "vara", "filing_date", "decision_date", "claim_value", "sentence_outcome", "segredo_justica",
        F.when(F.col("case_id") % 7 == 0, " Laudo médico anexo.").otherwise("").alias("_more"),
    )
    told = ["Processo ", "process_number", ": ", F.upper("party_name"), " (CPF ", "cpf", ") perante ", "judge_name", "."]
    parts = [F.col(x) if isinstance(x, str) and x in raw.columns else x if not isinstance(x, str) else F.lit(x) for x in told]
    raw = raw.withColumn("sentence_text", F.concat(*parts, "_more")).drop("_more")
    released = stage(privacy.anonymise(raw, DEMO_KEY), "released")
    privacy.assert_no_pii(released)
    return released


def book_ids(spark, folder):
    return casebook.cases(spark, folder).select("case_id", ids.public_id(F.col("case_id")).alias("book_id"))


def book_labels(spark, folder):
    """Three-way label, filing date from elapsed days, year and log amount."""
    rows = casebook.book_cases(spark, folder)
    return rows.select(
        "case_id",
        tables.three_way_label("decision_outcome", ("F",), ("O",)).alias("reformed"),
        tables.binary_label("decision_outcome", ("F", "P")).alias("binary_label"),
        F.date_sub("decision_date", F.col("case_days")).alias("filing_date"),
        F.year("filing_date").alias("filing_year"),
        F.round(F.log1p("claim_value"), 6).alias("claim_value_log"),
        F.round(F.expm1(F.log1p("claim_value")), 2).alias("claim_value_back"),
    )


def date_shift(spark, folder):
    shift = ids.date_shift_days(DEMO_KEY)
    return casebook.cases(spark, folder).select(
        "case_id",
        F.date_add("filing_date", shift).alias("filing_date"),
        F.date_add("decision_date", shift).alias("decision_date"),
    )


def sig_round(spark, folder):
    amount = F.col("claim_value")
    return casebook.cases(spark, folder).select(
        "case_id",
        numeric.round_significant(amount, 2).alias("two_digits"),
        numeric.round_significant(amount, 4).alias("four_digits"),
        numeric.half_decade_band(amount).alias("claim_band"),
    )


def scrub_documents(spark, folder):
    docs = casebook.text_table(spark, folder, "documents")
    return docs.select("doc_id", F.sha2(text.scrub(F.col("text")), 256).alias("scrubbed_sha256"))


def scrub_pages(spark, folder):
    pages = casebook.text_table(spark, folder, "pages")
    return pages.select("page_id", F.sha2(text.scrub(F.col("html")), 256).alias("scrubbed_sha256"))


def scrub_conversations(spark, folder):
    turns = casebook.text_table(spark, folder, "conversations")
    cleaned = text.scrub(F.col("text"))
    redacted = F.when(text.has_sensitive_terms(F.col("text")), F.lit(text.REDACTED_TEXT)).otherwise(cleaned)
    return turns.select("conv_id", "turn", F.sha2(redacted, 256).alias("released_sha256"))


def pii_scan_documents(spark, folder):
    scans = [
        privacy.pii_scan(casebook.text_table(spark, folder, name)).withColumn("table_name", F.lit(name))
        for name in ("documents", "pages", "conversations")
    ]
    return scans[0].unionByName(scans[1]).unionByName(scans[2])


def sensitive_documents(spark, folder):
    docs = casebook.text_table(spark, folder, "documents")
    flagged = docs.withColumn("sensitive", text.has_sensitive_terms(F.col("text")))
    return flagged.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("sensitive").alias("sensitive_documents")
    )


def secrecy_filter(spark, folder):
    return privacy.without_secret(casebook.cases(spark, folder)).select("case_id", "uf", "vara")


def row_reconciliation(spark, folder):
    """Rows by stage: loaded, not secret, one per case, usable for regression."""
    loaded = casebook.cases_with_duplicates(spark, folder)
    secret = F.coalesce(F.col("segredo_justica"), F.lit(False))
    per_case = loaded.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if(~secret).alias("open_copies"),
        F.min_by("claim_value", "load_order").alias("first_value"),
    )
    return per_case.agg(
        F.sum("copies").alias("rows_loaded"),
        F.sum("open_copies").alias("rows_open"),
        F.count_if(F.col("open_copies") > 0).alias("rows_distinct"),
        F.count_if((F.col("open_copies") > 0) & F.col("first_value").isNotNull()).alias("rows_usable"),
    )


def risk_linkage(spark, folder):
    return privacy.reidentification_risk(casebook.cases(spark, folder), 5, linkage=True)


def risk_internal(spark, folder):
    return privacy.reidentification_risk(casebook.cases(spark, folder), 5, linkage=False)


def l_diversity(spark, folder):
    return privacy.l_diversity(casebook.cases(spark, folder))


def suppress_k5(spark, folder):
    kept = privacy.suppress_small_groups(casebook.cases(spark, folder), 5)
    return kept.select("case_id", "uf", "comarca", "vara")


def k_anonymity_lt5(spark, folder):
    return privacy.k_anonymity(casebook.cases(spark, folder), ["comarca", "vara", "judge_id"], 5)


def profile_columns(spark, folder):
    return profile.column_profile(_profiled(spark, folder))


def _profiled(spark, folder):
    return casebook.cases(spark, folder).select(
        "case_id", "judge_id", "uf", "comarca", "vara", "filing_date", "claim_value", "unfavorable"
    )


def missing_by_column(spark, folder):
    return profile.missing_by_column(_profiled(spark, folder))


def missing_none(spark, folder):
    return profile.missing_by_column(_profiled(spark, folder).drop("claim_value"))


def id_like(spark, folder):
    return profile.id_like_columns(_profiled(spark, folder))


def target_summary(spark, folder):
    return profile.target_summary(casebook.cases(spark, folder), "claim_value")


def value_summary(spark, folder):
    return profile.value_summary(casebook.cases(spark, folder), "claim_value")


def _rounded_edges(table: DataFrame) -> DataFrame:
    return table.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


def hist_log(spark, folder):
    return _rounded_edges(profile.log_histogram(casebook.cases(spark, folder), "claim_value"))


def hist_clipped(spark, folder):
    return _rounded_edges(profile.clipped_histogram(casebook.cases(spark, folder), "claim_value", 40))


def eta_squared(spark, folder):
    groups = ["judge_id", "comarca", "uf", "vara"]
    return profile.variance_explained(casebook.cases(spark, folder), "claim_value", groups)


def _grain_with_value(spark: SparkSession, folder: str) -> DataFrame:
    """One history grain with the exact amount beside it."""
    base = _whole_cents(casebook.cases(spark, folder))
    table = history.attach_history(base, base, "comarca", "h", "rate", 180, "unfavorable")
    return table.select(
        "case_id",
        F.month("filing_date").alias("filing_month"),
        F.col("h_n_prior").alias("n_prior"),
        (F.col("h_avg_value_prior") / 100).alias("avg_value_prior"),
        F.col("h_rate").alias("label_rate_prior"),
        (F.col("claim_value") / 100).alias("claim_value"),
    )


def spearman(spark, folder):
    return profile.spearman(_grain_with_value(spark, folder), NUMERIC, "claim_value")


def spearman_ranking(spark, folder):
    """Features by the size of their correlation, ties by name; a row for each feature."""
    table = profile.spearman(_grain_with_value(spark, folder), NUMERIC, "claim_value")
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("spearman")), "feature")
    return table.select("feature", F.row_number().over(order).alias("place"))


def missing_by_group(spark, folder):
    return profile.missing_by_group(casebook.cases(spark, folder), "claim_value", "comarca")


def by_group(spark, folder):
    return profile.by_group(casebook.cases(spark, folder), "comarca", "claim_value", "unfavorable")


def value_counts(spark, folder):
    return profile.value_counts(casebook.book_cases(spark, folder), "assunto")


def label_balance(spark, folder):
    return profile.label_balance(casebook.book_cases(spark, folder), "reformed")


def group_error_bars(spark, folder):
    table = profile.group_error_bars(casebook.cases(spark, folder), "comarca", F.log1p("claim_value"))
    return table.withColumns({"mean": F.round("mean", 6), "sem": F.round("sem", 6)})


def monthly(spark, folder):
    return profile.monthly(casebook.cases(spark, folder))


def quarterly_filled(spark, folder):
    return profile.quarterly(casebook.book_cases(spark, folder))


def top15_comarca(spark, folder):
    return profile.top_values(casebook.book_cases(spark, folder), "comarca", 15)


def _split(spark, folder, purge):
    parts = split.temporal_split(casebook.cases(spark, folder), 0.2, purge=purge)
    tagged = [p.select("case_id", F.lit(n).alias("part")) for n, p in (("train", parts.train), ("test", parts.test))]
    return tagged[0].unionByName(tagged[1])


def temporal_split(spark, folder):
    return _split(spark, folder, False)


def temporal_split_purged(spark, folder):
    return _split(spark, folder, True)


def ts_folds(spark, folder):
    return split.with_time_folds(casebook.cases(spark, folder)).select("case_id", "fold")


def fit_validation(spark, folder):
    fit, validation = split.fit_validation_split(casebook.cases(spark, folder))
    return fit.select("case_id", F.lit("fit").alias("part")).unionByName(
        validation.select("case_id", F.lit("validation").alias("part"))
    )


def onehot_minfreq(spark, folder):
    """Fitted on the training part, applied to every row."""
    rows = casebook.cases(spark, folder).withColumn("month_key", F.date_format("filing_date", "yyyy-MM"))
    train = split.temporal_split(rows).train
    most = train.groupBy("month_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    encoder = encode.fit_one_hot(train, "month_key", most // 2 + most // 3)
    placed = encoder.with_slot(rows, "slot")
    vector = vector_to_array(encode.sparse_vector([("slot", encoder.width)], []))
    ones = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x)
    return placed.select("case_id", encoder.category("slot").alias("category"), ones.alias("ones"))


def target_encode(spark, folder):
    """Fitted on the training part: cross-fitted there, full statistics for later rows."""
    rows = casebook.cases(spark, folder).select("case_id", "judge_id", "filing_date", "unfavorable")
    parts = split.temporal_split(rows)
    fold = F.pmod(F.col("case_id"), F.lit(5)).cast("int")
    train = encode.cross_fit_target_encoding(parts.train, ["judge_id"], "unfavorable", fold)
    codes, mean = encode.fit_target_encoding(parts.train, "judge_id", "unfavorable")
    test = encode.apply_target_encoding(parts.test, codes, "judge_id", mean)
    both = train.unionByName(test)
    return both.select("case_id", F.round("judge_id_enc", 6).alias("judge_id_enc"))


def impute_standardise(spark, folder):
    rows = stage(_grain_with_value(spark, folder), "grain")
    scaler = encode.fit_scaler(rows.filter(F.col("claim_value").isNotNull()), NUMERIC, "claim_value")
    scaled = rows.select("case_id", *scaler.columns(), scaler.label("claim_value").alias("label_z"))
    return scaled.select("case_id", *[F.round(c, 5).alias(c) for c in scaled.columns if c != "case_id"])


def vocab_index(spark, folder):
    """Vocabulary of the training part; later customers are index 0."""
    rows = casebook.cases(spark, folder).select("case_id", "judge_name", "filing_date")
    vocabulary = encode.fit_vocabulary(split.temporal_split(rows).train, "judge_name")
    return encode.apply_vocabulary(rows, vocabulary, "judge_name").select("case_id", "judge_name_index")


def scored_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Cases with a fixed predictor, so that statistics of predictions can be compared."""
    case_id = F.col("case_id")
    return casebook.cases(spark, folder).select(
        "case_id",
        "uf",
        "comarca",
        "vara",
        "claim_value",
        "unfavorable",
        (F.col("claim_value") * (F.lit(0.5) + F.pmod(case_id, F.lit(100)) / F.lit(100.0))).alias("prediction"),
        (F.pmod(case_id, F.lit(101)) / F.lit(100.0)).alias("proba"),
    )


def _valued(spark, folder):
    return scored_cases(spark, folder).filter(F.col("claim_value").isNotNull())


def _rounded(table: DataFrame, digits: int = 6) -> DataFrame:
    return table.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in table.dtypes]
    )


def reg_metrics(spark, folder):
    return _rounded(evaluate.regression_metrics(_valued(spark, folder), "claim_value", "prediction"))


def baseline_predictions(spark, folder):
    """No-skill baselines: median in log space and the label rate, from the training part."""
    rows = casebook.cases(spark, folder)
    valued = split.temporal_split(rows.filter(F.col("claim_value").isNotNull())).train
    labelled = split.temporal_split(rows, purge=True).train
    median = profile.exact_quantiles(
        valued, "claim_value", {"m": 0.5}, transform={"m": F.log1p}
    ).select(F.round(F.expm1("m"), 4).alias("median_prediction"))
    return beside(median, labelled.agg(F.round(F.avg("unfavorable"), 6).alias("prior_probability")))


def cls_metrics(spark, folder):
    return _rounded(evaluate.classification_metrics(scored_cases(spark, folder), "unfavorable", "proba"))


def roc_auc(spark, folder):
    """Per uf and overall, from one ordering each."""
    rows = scored_cases(spark, folder)
    groups = evaluate.roc_auc(rows, "unfavorable", "proba", ["uf"])
    overall = evaluate.roc_auc(rows, "unfavorable", "proba").select(F.lit("all").alias("uf"), "roc_auc")
    return _rounded(groups.unionByName(overall))


def avg_precision(spark, folder):
    return _rounded(evaluate.average_precision(scored_cases(spark, folder), "unfavorable", "proba"))


def error_slices(spark, folder):
    return _rounded(evaluate.error_slices(_valued(spark, folder), "claim_value", "prediction", "uf"), 4)


def prediction_picks(spark, folder):
    """The lowest, the median and the highest prediction, with their cases."""
    return attribution.pick_cases(_valued(spark, folder).select("case_id", "prediction"))


def case_order(spark, folder):
    """Every case's position in the order that sinks write: by filing date, then by id."""
    table = cumulative(casebook.cases(spark, folder), ["filing_date", "case_id"], {"n": F.count(F.lit(1))})
    return table.select("case_id", F.col("before_n").alias("position"))


def wilcoxon_stat(spark, folder):
    """Signed ranks of the fixed predictor's loss against a constant predictor's."""
    losses = _valued(spark, folder).select(
        F.abs(F.col("claim_value") - F.col("prediction")).alias("loss"),
        F.abs(F.col("claim_value") - F.lit(250000.0)).alias("base"),
    )
    return evaluate.wilcoxon_stats(losses, "loss", "base").select(
        "n_pairs",
        "n_ranked",
        F.round("statistic", 1).alias("statistic"),
        F.round("w_plus", 1).alias("w_plus"),
        F.round("w_minus", 1).alias("w_minus"),
        F.round("median_loss_model", 4).alias("median_loss_model"),
        F.round("median_loss_baseline", 4).alias("median_loss_baseline"),
        F.round("median_loss_difference", 4).alias("median_loss_difference"),
    )


def peer_z(spark, folder):
    table = anomaly.peer_z(casebook.cases(spark, folder))
    return table.select("case_id", F.round("peer_z", 6).alias("peer_z"))


def peer_z_small_groups(spark, folder):
    """Groups of one customer are mostly small, so most rows fall back to the whole table."""
    table = anomaly.peer_z(casebook.cases(spark, folder), peers=("judge_id",), min_group=10)
    return table.select("case_id", F.round("peer_z", 6).alias("peer_z"))


def request_validation(spark, folder):
    """Requests made from cases, some out of range."""
    rows = casebook.cases(spark, folder)
    case_id = F.col("case_id")
    requests = rows.select(
        "case_id",
        F.when(case_id % 3 == 0, F.substring("uf", 1, 3)).otherwise(F.substring("uf", 1, 2)).alias("uf"),
        F.when(case_id % 7 == 0, F.repeat("comarca", 20)).otherwise(F.col("comarca")).alias("comarca"),
        "vara",
        F.col("judge_name").alias("judge_id"),
        (F.month("filing_date") + F.when(case_id % 5 == 0, 6).otherwise(0)).alias("filing_month"),
        F.when(case_id % 2 == 0, (case_id % 130) / 100.0).alias("judge_unfav_rate_prior"),
        F.lit(None).cast("double").alias("comarca_unfav_rate_prior"),
    )
    checked = rules.validate_requests(requests)
    return checked.select("case_id", "valid", F.array_join("errors", ",").alias("errors"))


def sample_k(spark, folder):
    return split.deterministic_sample(casebook.cases(spark, folder).select("case_id", "uf"), 800)


def isolation_flags(spark, folder):
    return anomaly.flag_anomalies(casebook.cases(spark, folder))


def bootstrap_ci(spark, folder):
    """Intervals of mean absolute error, Brier score and AUC of the fixed predictor."""
    rows, valued = scored_cases(spark, folder), _valued(spark, folder)
    error = F.abs(F.col("claim_value") - F.col("prediction"))
    squared = (F.col("unfavorable") - F.col("proba")) ** 2
    results = [
        ("mae", *evaluate.bootstrap_mean_ci(valued, error)),
        ("brier", *evaluate.bootstrap_mean_ci(rows, squared)),
        ("roc_auc", *evaluate.bootstrap_auc_ci(rows, "unfavorable", "proba")),
    ]
    return _rounded(spark.createDataFrame(results, "metric string, lower double, upper double"))


def _after_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cases before and after a load: tenths of them added, removed, and decided 15 days later."""
    base = _whole_cents(casebook.cases(spark, folder))
    tenth = F.pmod(F.col("case_id"), F.lit(10))
    before = base.filter(tenth != 1)
    later = F.when(tenth == 3, F.date_add("decision_date", 15)).otherwise(F.col("decision_date"))
    after = base.filter(tenth != 2).withColumn("decision_date", later)
    return before, after, base.filter(tenth.isin(1, 2, 3)).select("case_id")


def incremental_features(spark, folder):
    """Features refreshed after a load; must equal a full rebuild."""
    before, after, changed = _after_changes(spark, folder)
    built = stage(history.feature_table(before, schema.TESTBED), "features-before")
    table = incremental.refresh_features(built, before, after, changed, schema.TESTBED)
    return _in_currency(table, "claim_value", "judge_avg_value_prior", "comarca_avg_value_prior")


def incremental_load(spark, folder):
    """Two loads upserted by key; the second changes some cases and moves some to other months."""
    base = casebook.cases(spark, folder).select("case_id", "uf", "filing_date", "claim_value")
    case_id = F.col("case_id")
    first = base.filter(case_id % 3 != 0).withColumn("loaded_at", F.lit(1))
    moved = F.when(case_id % 2 == 0, F.date_sub("filing_date", 40)).otherwise(F.col("filing_date"))
    second = base.filter((case_id % 3 == 0) | (case_id % 5 == 0)).withColumns(
        {"filing_date": moved, "loaded_at": F.lit(2)}
    )
    path = f"{work_folder(spark)}/upserts-{uuid.uuid4().hex[:12]}"
    table = incremental.upsert(spark, path, first, "case_id", "loaded_at")
    news = incremental.newer_than(
        first.unionByName(second), "loaded_at", incremental.high_water_mark(table, "loaded_at")
    )
    return incremental.upsert(spark, path, news, "case_id", "loaded_at").drop(incremental.PART)


def stream_gate(spark, folder):
    """Events through a stream: pseudonymised, scrubbed, one row per event, written by micro-batch."""
    layout = casebook.table(spark, folder, "events").schema
    events = spark.readStream.schema(layout).parquet(f"{folder}/events*.parquet")
    released = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        ids.pseudonym(F.col("user_id"), DEMO_KEY, "USER", digits=True).alias("user_pseudonym"),
        "event_type",
        text.scrub(F.col("props")).alias("props"),
    )
    base = f"{work_folder(spark)}/stream-{uuid.uuid4().hex[:12]}"
    writer = gate.write_gated(released, f"{base}/out", f"{base}/checkpoint", "event_id", "ts")
    gate.run_available(writer)
    return gate.read_batches(spark, f"{base}/out").drop("ts")


#: Choices tried of each candidate's grid.
N_ITER = 8


def _leaderboard(spark, folder, task):
    """Cross-validated on the past, measured on the future; small tables are fitted in few tasks, many fits at a time."""
    table = stage(history.feature_table(casebook.cases(spark, folder), schema.TESTBED), "features")
    data = models.task_data(table, schema.TESTBED, task)
    threads = min(16, max(4, spark.sparkContext.defaultParallelism))
    board = models.compete(data, schema.TESTBED, task, N_ITER, models.candidates(task), threads).leaderboard(spark)
    score = "test_mae" if task == "regression" else "test_roc_auc"
    return board.select(F.lit(task).alias("task"), "model", "cv_score", "cv_score_std", F.col(score).alias("test_score"))


def leaderboard_regression(spark, folder):
    return _leaderboard(spark, folder, "regression")


def leaderboard_classification(spark, folder):
    return _leaderboard(spark, folder, "classification")


_fitted: dict[tuple, tuple] = {}
_features: dict[tuple, DataFrame] = {}


def _feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table that fits and requests share; written once per application and folder."""
    memo = casebook.source_state(spark, folder)
    if memo not in _features:
        _features[memo] = stage(history.feature_table(casebook.cases(spark, folder), schema.TESTBED), "features")
    return _features[memo]


def _forest(spark: SparkSession, folder: str, task: str) -> tuple[models.FittedModel, DataFrame]:
    """A forest fitted on the past and the rows after it; fitted once per application and folder."""
    memo = (casebook.source_state(spark, folder), task)
    if memo not in _fitted:
        data = models.task_data(_feature_table(spark, folder), schema.TESTBED, task)
        params = {"maxDepth": 6, "minInstancesPerNode": 30}
        candidate = models.candidates(task)["random_forest"]
        model = models.fit_model(data.train, schema.TESTBED, task, "random_forest", candidate, params)
        _fitted[memo] = (model, data.test)
    return _fitted[memo]


def perm_importance(spark, folder):
    found = []
    for task in schema.TASKS:
        model, test = _forest(spark, folder, task)
        table = models.permutation_importance(model, test, schema.TESTBED)
        found.append(table.select(F.lit(task).alias("task"), "feature", "importance"))
    return found[0].unionByName(found[1])


def tree_shap_additivity(spark, folder):
    """Largest gap between model output and explained sum over every test row."""
    rows = []
    for task in schema.TASKS:
        model, test = _forest(spark, folder, task)
        found = attribution.explain(model, test, schema.TESTBED.targets()[task], max_cases=None)
        rows.append((task, found.kind, found.space, found.rows.count(), round(found.error, 6), found.error < 1e-6))
    layout = "task string, explainer string, output_space string, cases bigint, max_error double, ok boolean"
    return spark.createDataFrame(rows, layout)


def shap_importance(spark, folder):
    model, test = _forest(spark, folder, "regression")
    return attribution.explain(model, test, "claim_value", max_cases=None).importance()


def shap_cases(spark, folder):
    """Every non-zero contribution of every test row."""
    model, test = _forest(spark, folder, "classification")
    found = attribution.explain(model, test, "unfavorable", max_cases=None)
    return attribution.long_form(found.rows, found.names, "case_id", "unfavorable", "prediction", "base_value")


def score_batch(spark, folder):
    """Requests made from every row of the feature table, validated and scored for both tasks."""
    value_model, _ = _forest(spark, folder, "regression")
    chance_model, _ = _forest(spark, folder, "classification")
    requests = _feature_table(spark, folder).withColumn("judge_id", F.col("judge_id").cast("string"))
    valid, _ = scoring.split_requests(requests)
    scored = scoring.score(chance_model, scoring.score(value_model, valid).drop("model", "trained_at"))
    return scored.select("case_id", "predicted_claim_value", "probability_unfavorable", "model")


REPORTS = {
    f.__name__: f
    for f in (
        abt_comarca_180, abt_customer_180, abt_full, abt_book_365, dq_profile, dq_checks,
        constraint_report, book_rules, domain_values, spearman_ranking, prediction_picks, case_order,
        unknown_domain, dedupe_keep_first, dedupe_keep_latest, pseudonyms, gate_release,
        book_ids, book_labels, date_shift, sig_round, scrub_documents, scrub_pages,
        scrub_conversations, pii_scan_documents, sensitive_documents, secrecy_filter,
        row_reconciliation, risk_linkage, risk_internal, l_diversity, suppress_k5, k_anonymity_lt5,
        profile_columns, missing_by_column, missing_none, id_like, target_summary, value_summary,
        hist_log, hist_clipped, eta_squared, spearman, missing_by_group, by_group, value_counts,
        label_balance, group_error_bars, monthly, quarterly_filled, top15_comarca, temporal_split,
        temporal_split_purged, ts_folds, fit_validation, onehot_minfreq, target_encode,
        impute_standardise, vocab_index, reg_metrics, baseline_predictions, cls_metrics, roc_auc,
        avg_precision, error_slices, wilcoxon_stat, peer_z, peer_z_small_groups, request_validation,
        sample_k, isolation_flags, bootstrap_ci, incremental_features, incremental_load, stream_gate,
        leaderboard_regression, leaderboard_classification, perm_importance, tree_shap_additivity, shap_importance, shap_cases, score_batch,
    )
}
