"""Quality rules with robust multivariate outliers: minimum covariance determinant by language and source.

**Statistics.** One pass counts words, their code points, symbols, lines that repeat and words in repeated windows of five. A row
whose counts break the base rules is rejected at once and takes no part in the estimates.

**Transformed vectors.** Log mean word length and log symbol rate, the shares of repeated lines and of words in
repeated windows, and the log share of distinct words over the log of the length; short texts are drawn towards the
middle by pseudo-counts. Values are rounded to 1/4096, so sums of them do not depend on the order of rows.

**Groups.** A row belongs to its (language, source); groups with fewer than ``LEAST_ROWS`` rows form one pool for each
language, and pools with fewer still form one for the table. If that too has fewer, nothing of it is rejected.

**Minimum covariance determinant.** Every group starts twice: from medians and quartile ranges, and from the spatial-sign
covariance about the medians. A concentration step takes each row's Mahalanobis distance, finds the half with the smallest
ones and estimates centre and covariance from it; this never enlarges the determinant, and the start with the smaller one wins.
All rows of all groups take part in every step: distances fall into logarithmic bins, the sums of a bin are combined inside
tasks, and the bin in which the half ends counts in part. So a step shuffles some hundred sums a group, whatever
its size; no group is ever in one task. ``FLOORS`` is added to each variance, as most texts have no symbol and no repeat at all.

Distances are divided by their median over the chi-squared median if that exceeds one. A row is rejected above the
``QUANTILE`` of the chi-squared law.

Defined results: null and empty texts have no words and fail the base rules; null languages and sources are groups of their
own; rows that repeat count again; columns may have any names; very long texts need some 50 bytes a word; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlake.llm.common import drop_table, free_name, whole
from pitlake.session import stage

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
PSEUDO_WORDS, PSEUDO_LENGTH = 30, 5  # a short text counts as if it had these besides
#: Spread that every statistic has at least, in the units of the vector.
FLOORS = (0.06, 0.05, 0.1, 0.06, 0.03)
SIZE = len(FLOORS)
LEAST_ROWS = 100
HALF = 0.5
STEPS = 12
QUANTILE = 0.9999
BINS = 16  # for each doubling of a distance
GRID = 4096


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside runs of ``window`` words that the list holds twice or more."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    runs = ids
    for j in range(1, window):  # numbers of runs, longer by one word each time; equal runs have equal numbers
        _, runs = np.unique(runs[: n - j] * len(number) + ids[j:], return_inverse=True)
        if runs.max() == len(runs) - 1:
            return 0
    often = np.bincount(runs)[runs] > 1
    steps = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + window, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def measured(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, distinct words."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    chars = len(text) - (len(data) - len(data.translate(None, WHITE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines, repeats, seen = 0, 0, set()
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                repeats += 1
            seen.add(line)
    return len(words), chars, symbols, repeats, repeated_words(words), lines, len(set(words))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = (*COUNTS, "n_lines", "n_distinct")


def statistics(docs: DataFrame, text: str = "text", output: str = "counts") -> DataFrame:
    """``docs`` with one more column: the counts of the whole text."""

    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measured(t) for t in whole(texts)], columns=list(FIELDS), dtype="int64")

    return docs.withColumn(output, F.pandas_udf(measure, ", ".join(f"{f} long" for f in FIELDS))(F.col(text)))


def base_failed(counts: str = "counts") -> Column:
    words, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeats > REPEAT_PERCENT * words)


def vector(counts: str = "counts") -> list[Column]:
    words, chars, symbols, dup, rep, lines, distinct = (F.col(f"{counts}.{f}") for f in FIELDS)
    more = words + PSEUDO_WORDS
    parts = [
        F.log((chars + PSEUDO_WORDS * PSEUDO_LENGTH) / more),
        F.log1p(symbols / (words + 10)),
        dup / (lines + 2),
        rep / (words + 10),
        F.log((distinct + PSEUDO_WORDS) / more) / F.log(words + math.e),
    ]
    return [F.round(p * GRID) / GRID for p in parts]


Z = [f"z{i}" for i in range(SIZE)]
MU = [f"mu{i}" for i in range(SIZE)]
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
WHITEN = [f"w{i}_{j}" for i, j in PAIRS]  # inverse of the covariance's lower Cholesky factor
MODEL = ["log_det", *MU, *WHITEN]
MODEL_TYPE = "g string, start int, " + ", ".join(f"{c} double" for c in MODEL)


def distance() -> Column:
    """Squared Mahalanobis distance of a row's vector from the centre beside it."""
    parts = []
    for i in range(SIZE):
        terms = [F.col(f"w{i}_{j}") * (F.col(Z[j]) - F.col(MU[j])) for j in range(i + 1)]
        parts.append(sum(terms[1:], terms[0]))
    return sum((p * p for p in parts[1:]), parts[0] * parts[0])


def model_row(g: str, start: int, centre: np.ndarray, covariance: np.ndarray) -> tuple:
    covariance = covariance + np.diag(np.square(FLOORS))
    white = np.linalg.inv(np.linalg.cholesky(covariance))
    log_det = -2 * np.log(np.diag(white)).sum()
    return (g, start, float(log_det), *map(float, centre), *(float(white[i, j]) for i, j in PAIRS))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["g", "start", *MODEL])


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (lang, source, ...) with the group ``g`` whose estimate each one takes."""
    own = F.concat(F.lit("2"), F.to_json(F.struct("lang", "source")))
    language = F.concat(F.lit("1"), F.to_json(F.struct("lang")))
    rows = rows.withColumn("own", own)
    sizes = rows.select("own", language.alias("pool")).groupBy("own", "pool").agg(F.count("*").alias("n"))
    pools = sizes.filter(f"n < {LEAST_ROWS}").groupBy("pool").agg(F.sum("n").alias("m"))
    chosen = sizes.join(pools, "pool", "left").select(
        "own", F.when(F.col("n") >= LEAST_ROWS, F.col("own")).when(F.col("m") >= LEAST_ROWS, F.col("pool")).otherwise("0").alias("g")
    )
    return rows.join(chosen, "own").drop("own")


def _met(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Each row with the models of its group. They meet by group and salt, so a hot group is dealt to many tasks."""
    salts = F.sequence(F.lit(0), F.lit(_salts(rows) - 1))
    return rows.join(models.withColumn("salt", F.explode(salts)), ["g", "salt"]).drop("salt")


def _salts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _quartiles(rows: DataFrame) -> DataFrame:
    """(g, i, q1, q2, q3) of each coordinate, from bins of a quarter of its floor."""
    bins = [F.struct(F.lit(i).alias("i"), F.floor(F.col(z) / (FLOORS[i] / 4)).alias("bin")) for i, z in enumerate(Z)]
    counts = rows.select("g", F.explode(F.array(*bins)).alias("x")).groupBy("g", "x.i", "x.bin").agg(F.count("*").alias("n"))
    within = Window.partitionBy("g", "i")
    run = counts.withColumn("upto", F.sum("n").over(within.orderBy("bin"))).withColumn("all", F.sum("n").over(within))
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin")))
    return run.groupBy("g", "i").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))


def _first_models(rows: DataFrame) -> DataFrame:
    """Start 0 of every group: medians, and quartile ranges as spreads."""
    found = _quartiles(rows).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("i", "q1", "q2", "q3"))).alias("q"))

    def fit(batches):
        for batch in batches:
            out = []
            for g, q in zip(batch["g"], batch["q"], strict=True):
                step = np.array(FLOORS) / 4
                centre = np.array([(x["q2"] + 0.5) for x in q]) * step
                spread = np.array([x["q3"] - x["q1"] for x in q]) * step / 1.349
                out.append(model_row(g, 0, centre, np.diag(spread**2)))
            yield _frame(out)

    return found.mapInPandas(fit, MODEL_TYPE)


def _sums(values: list[Column]) -> list[Column]:
    """Sums of the values and of their products."""
    return [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)] + [
        F.sum(values[i] * values[j]).alias(f"s{i}_{j}") for i, j in PAIRS
    ]


SUMS = [f"s{i}" for i in range(SIZE)] + [f"s{i}_{j}" for i, j in PAIRS]


def _square(values: list[float]) -> np.ndarray:
    out = np.zeros((SIZE, SIZE))
    for (i, j), v in zip(PAIRS, values, strict=True):
        out[i, j] = out[j, i] = v
    return out


def _sign_models(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Start 1: covariance of the directions in which rows lie from the medians, in units of start 0's spreads."""
    away = [(F.col(z) - F.col(m)) * F.col(f"w{i}_{i}") for i, (z, m) in enumerate(zip(Z, MU, strict=True))]
    length = F.sqrt(sum((a * a for a in away[1:]), away[0] * away[0]))
    unit = _met(rows, first).select("g", *[F.when(length > 0, a / length).otherwise(0.0).alias(z) for a, z in zip(away, Z, strict=True)])
    sums = unit.groupBy("g").agg(F.count("*").alias("n"), *_sums([F.col(z) for z in Z])).join(first, "g")

    def fit(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                shape = _square([r[f"s{i}_{j}"] for i, j in PAIRS]) / r["n"] * SIZE
                spread = np.array([1 / r[f"w{i}_{i}"] for i in range(SIZE)])
                out.append(model_row(r["g"], 1, np.array([r[m] for m in MU]), shape * np.outer(spread, spread)))
            yield _frame(out)

    return sums.mapInPandas(fit, MODEL_TYPE)


def _binned(rows: DataFrame, models: DataFrame, sums: list[Column]) -> DataFrame:
    """Sums by (g, start, bin of the distance), with the rows of the group up to the bin and in all."""
    bin_ = F.floor(F.log2(F.greatest(distance(), F.lit(1e-9))) * BINS).cast("int")
    bins = _met(rows, models).withColumn("bin", bin_).groupBy("g", "start", "bin").agg(F.count("*").alias("n"), *sums)
    within = Window.partitionBy("g", "start")
    return bins.withColumn("upto", F.sum("n").over(within.orderBy("bin"))).withColumn("all", F.sum("n").over(within))


def _concentrated(rows: DataFrame, models: DataFrame) -> DataFrame:
    """One concentration step of every group and start."""
    half = F.floor(F.col("all") * HALF) + 1
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (half - (F.col("upto") - F.col("n"))) / F.col("n")))
    bins = _binned(rows, models, _sums([F.col(z) for z in Z])).withColumn("weight", weight)
    taken = bins.groupBy("g", "start").agg(F.sum(F.col("weight") * F.col("n")).alias("h"), *[F.sum(F.col("weight") * F.col(s)).alias(s) for s in SUMS])

    def fit(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                centre = np.array([r[f"s{i}"] for i in range(SIZE)]) / r["h"]
                square = _square([r[f"s{i}_{j}"] for i, j in PAIRS]) / r["h"] - np.outer(centre, centre)
                out.append(model_row(r["g"], r["start"], centre, square))
            yield _frame(out)

    return taken.mapInPandas(fit, MODEL_TYPE)


def chi_square_quantile(share: float, freedom: int) -> float:
    """Point below which a chi-squared variable lies with probability ``share``: bisection on the series of its law."""

    def below(x: float) -> float:
        a, y = freedom / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= y / k
            total += term
        return total * math.exp(a * math.log(y) - y - math.lgamma(a))

    low, high = 1e-9, 10.0 * freedom + 100
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return (low + high) / 2


def fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(g, scale, centre and whitening) of every group of ``rows`` (g, salt, z0, z1, ...), written to the shared folder."""
    first = stage(_first_models(rows), "mcd-starts")
    models = stage(first.unionAll(_sign_models(rows, first)), "mcd")
    drop_table(first)
    for _ in range(steps):
        after = stage(_concentrated(rows, models), "mcd")
        before = models.select("g", "start", F.col("log_det").alias("before"))
        settled = after.join(before, ["g", "start"]).filter("abs(log_det - before) > 1e-6").isEmpty()
        drop_table(models)
        models = after
        if settled:
            break
    whole_model = F.struct("log_det", "start", *MU, *WHITEN)
    best = models.groupBy("g").agg(F.min(whole_model).alias("m")).select("g", "m.*")
    median = F.min(F.when(2 * F.col("upto") >= F.col("all"), F.col("bin")))
    medians = _binned(rows, best, []).groupBy("g").agg(F.pow(F.lit(2.0), (median + 0.5) / BINS).alias("median"), F.max("all").alias("n_rows"))
    scale = F.greatest(F.lit(1.0), F.col("median") / chi_square_quantile(0.5, SIZE))
    out = stage(best.join(medians, "g").select("g", scale.alias("scale"), "n_rows", "log_det", *MU, *WHITEN), "mcd-limits")
    drop_table(models)
    return out


def judged(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The named columns of every row (doc_id alone by default), its counts, ``base_failed``, ``distance`` and ``kept``."""
    columns = ["doc_id"] if columns is None else columns
    counts = free_name(docs, "counts")
    lang, source = (F.col(c).cast("string").alias(c) for c in ("lang", "source"))
    carried = F.struct(*[F.col(c) for c in columns]).alias("carried")
    rows = statistics(docs.select(carried, lang, source, "text"), output=counts)
    rows = rows.select("carried", "lang", "source", F.col(counts).alias("counts"))
    rows = stage(rows.select("*", base_failed().alias("base_failed"), *[v.alias(z) for v, z in zip(vector(), Z, strict=True)]), "statistics")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(_salts(rows))).cast("int")
    sound = stage(grouped(rows.filter("NOT base_failed")).withColumn("salt", salt), "groups")
    drop = F.col("distance") > chi_square_quantile(QUANTILE, SIZE)
    limits = fit(sound.select("g", "salt", *Z))
    known = sound.join(limits, "g").withColumn("distance", distance() / F.col("scale"))
    known = known.withColumn("kept", ~(drop & ((F.col("g") != "0") | (F.col("n_rows") >= LEAST_ROWS))))
    out = [*[F.col(f"carried.{c}").alias(c) for c in columns], *[F.col(f"counts.{c}").alias(c) for c in COUNTS], "base_failed", "kept", "distance"]
    failed = rows.filter("base_failed").withColumn("kept", F.lit(False)).withColumn("distance", F.lit(None).cast("double"))
    return known.select(*out).unionAll(failed.select(*out))


def report(docs: DataFrame) -> DataFrame:
    return judged(docs)
