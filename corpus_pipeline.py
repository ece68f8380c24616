"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, tokens.

``run`` applies the stages to ``documents`` one after another; each writes its rows, and the next
one reads them as its documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm import decontaminate, jaccard, secrets, toxicity, transducer, vocabulary
from pitlake.llm.common import free_name, read
from pitlake.session import work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below the threshold."""
    name = free_name(docs, "toxicity")
    scored = toxicity.scorer(docs, read(spark, sf_dir, "labels"))(docs, output=name)
    return scored.filter(F.col(f"{name}.score") < toxicity.THRESHOLD).select(docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked ones, and every document that links with none."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of a benchmark item."""
    name = free_name(docs, "leaks")
    found = decontaminate.scan(docs, read(spark, sf_dir, "benchmark"), output=name)
    return found.filter(F.col(f"{name}.n_hit") == 0).select(docs.columns)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; each secret in a text becomes the name of its kind, and n_chars follows."""
    name = free_name(docs, "secrets")
    found = secrets.scan(docs, output=name)
    changed = F.size(f"{name}.spans") > 0
    text = F.col(f"{name}.redacted")
    own = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[own.get(c, F.col(c)).alias(c) for c in docs.columns])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every row."""
    return transducer.report(docs, vocabulary.public_path(vocabulary.WORD_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", blank_secrets),
    ("bpe", tokenise),
]
#: The first and the last stage are no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
