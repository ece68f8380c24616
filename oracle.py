"""DuckDB SQL with the same results as the registered queries, for the correctness check."""

from __future__ import annotations

from pitlake.functions import ids, text
from pitlake.operators import rules
from pitlake.plans.reports import DEMO_KEY

BASE = """
WITH decided AS (
  SELECT o_orderkey, min(CAST(l_shipdate AS DATE)) AS decision_date
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) GROUP BY o_orderkey),
cases AS (
  SELECT o.o_orderkey AS case_id, o_custkey AS judge_id, substr(r_name, 1, 2) AS uf, n_name AS comarca,
    c_mktsegment AS vara, CAST(o_orderdate AS DATE) AS filing_date, d.decision_date,
    o_totalprice AS amount,
    CASE WHEN o.o_orderkey % 33 <> 0 THEN o_totalprice END AS claim_value,
    o_orderstatus AS sentence_outcome,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS unfavorable,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS reformed,
    o_orderpriority AS assunto, c_name AS judge_name, o.o_orderkey % 97 = 0 AS segredo_justica
  FROM orders o JOIN decided d ON d.o_orderkey = o.o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
book AS (SELECT case_id, assunto, comarca, vara AS tipo_litigio, filing_date, decision_date,
    amount AS claim_value, sentence_outcome AS decision_outcome, reformed,
    decision_date - filing_date AS case_days FROM cases)
"""


def history(name: str, source: str, key: str, window: int, label: str) -> str:
    """The range self-join by definition, with amounts as whole cents."""
    return f"""{name} AS (
  SELECT c.case_id, CAST(count(h.case_id) AS BIGINT) AS n,
    CAST(sum(CAST(round(h.claim_value * 100) AS BIGINT)) AS DOUBLE) / nullif(count(h.claim_value), 0) / 100 AS v,
    CAST(sum(h.{label}) AS DOUBLE) / nullif(count(h.{label}), 0) AS r
  FROM {source} c LEFT JOIN {source} h ON h.{key} = c.{key}
    AND h.decision_date < c.filing_date AND h.decision_date >= c.filing_date - {window}
  GROUP BY c.case_id)"""


def one_grain(key: str, window: int) -> str:
    return f"""{BASE}, {history("h", "cases", key, window, "unfavorable")}
SELECT case_id, CAST(month(filing_date) AS INT) AS filing_month, n AS n_prior,
  v AS avg_value_prior, r AS label_rate_prior FROM cases JOIN h USING (case_id)"""


ABT_FULL = f"""{BASE}, {history("j", "cases", "judge_id", 180, "unfavorable")},
{history("k", "cases", "comarca", 180, "unfavorable")}
SELECT c.case_id, judge_id, uf, comarca, vara, filing_date, decision_date, claim_value, unfavorable,
  CAST(month(filing_date) AS INT) AS filing_month, j.n AS judge_n_prior,
  j.v AS judge_avg_value_prior, j.r AS judge_unfav_rate_prior, k.n AS comarca_n_prior,
  k.v AS comarca_avg_value_prior, k.r AS comarca_unfav_rate_prior
FROM cases c JOIN j ON j.case_id = c.case_id JOIN k ON k.case_id = c.case_id"""

ABT_BOOK = f"""{BASE}, base AS (SELECT * FROM book WHERE reformed IS NOT NULL),
{history("k", "base", "comarca", 365, "reformed")}, {history("a", "base", "assunto", 365, "reformed")}
SELECT c.case_id, assunto, comarca, tipo_litigio, filing_date, decision_date, claim_value, reformed,
  CAST(month(filing_date) AS INT) AS filing_month, CAST(year(filing_date) AS INT) AS filing_year,
  round(ln(1 + claim_value), 6) AS claim_value_log, k.n AS comarca_n_prior,
  coalesce(k.v, 0) AS comarca_avg_value_prior, coalesce(k.r, 0) AS comarca_reform_rate_prior,
  a.n AS assunto_n_prior, coalesce(a.v, 0) AS assunto_avg_value_prior,
  coalesce(a.r, 0) AS assunto_reform_rate_prior
FROM base c JOIN k ON k.case_id = c.case_id JOIN a ON a.case_id = c.case_id"""


def rule_rows() -> str:
    rows = [
        f"SELECT '{r.name}' AS rule, CAST(count(*) FILTER (WHERE NOT ({r.condition})) AS BIGINT) AS violations FROM cases"
        for r in rules.CASE_RULES
    ]
    rows.append(
        "SELECT 'case_id_unique', count(*) FROM "
        "(SELECT case_id FROM cases GROUP BY case_id HAVING count(*) > 1)"
    )
    return BASE + " UNION ALL ".join(rows)


DUPLICATES = f"""{BASE}, loaded AS (SELECT *, 0 AS load_order FROM cases UNION ALL
  SELECT * REPLACE (claim_value + 1 AS claim_value), 1 FROM cases WHERE case_id % 100 = 0)"""


def dedupe(direction: str) -> str:
    return f"""{DUPLICATES} SELECT case_id, judge_id, filing_date, claim_value, load_order FROM (
  SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY load_order {direction}) AS r FROM loaded)
WHERE r = 1"""


def keyed(message: str, prefix: str) -> str:
    return f"'{prefix}_' || substr({mac(message)}, 1, 10)"


BOOK_COLUMNS = (
    "case_id", "assunto", "comarca", "tipo_litigio", "filing_date", "decision_date", "claim_value", "decision_outcome", "case_days",
)


def mac(message: str) -> str:
    inner, outer = (pad.hex() for pad in ids.key_pads(DEMO_KEY))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


#: Days of the keyed shift: -364 times one to five, by the first 32 bits of the MAC.
SHIFT = f"""CAST(-364 * (1 + ('0x' || substr({mac("'date-shift'")}, 1, 8))::BIGINT % 5) AS INTEGER)"""

PSEUDONYMS = f"""{BASE} SELECT case_id, {keyed("lower(trim(judge_name))", "JUDGE")} AS judge_pseudonym,
{keyed("regexp_replace(judge_name, '[^0-9]', '', 'g')", "CASE")} AS number_pseudonym FROM cases"""


#: Written from what the texts are made of, not by scrubbing them.
GATE = f"""{BASE} SELECT {keyed("lpad(CAST(case_id AS VARCHAR), 20, '0')", "CASE")} AS case_id,
  {keyed("lower(judge_name) || ' sao paulo'", "JUDGE")} AS judge_id, uf, comarca, vara, sentence_outcome,
  CAST(filing_date + {SHIFT} AS DATE) AS filing_date, CAST(decision_date + {SHIFT} AS DATE) AS decision_date,
  @SIG@ AS claim_value, CASE WHEN case_id % 7 = 0 THEN '[TEXTO_REMOVIDO_DADO_SENSIVEL_ART_11]'
    ELSE 'Processo [PROCESSO]: [NOME] (CPF [CPF]) perante [NOME].' END AS sentence_text
FROM cases WHERE NOT segredo_justica"""


def sig(digits: int) -> str:
    k = f"({digits - 1} - floor(log10(abs(claim_value))))"
    return (
        f"CASE WHEN {k} >= 0 THEN round_even(claim_value * pow(10, {k}), 0) / pow(10, {k}) "
        f"ELSE round_even(claim_value / pow(10, -{k}), 0) * pow(10, -{k}) END"
    )


# The oracle's regex engine has no look-around and ASCII-only classes: neighbours are captured and
# written back, and a second pass finds matches that shared a neighbour with the one before.
WORD = r"\p{L}\p{M}\p{N}_"
EDGE = {
    "process_number": (f"(^|[^{WORD}])", f"($|[^{WORD}])"),
    "cnpj": (f"(^|[^{WORD}])", f"($|[^{WORD}])"),
    "cpf": (f"(^|[^{WORD}])", f"($|[^{WORD}])"),
    "email": ("", ""),
    "phone": (r"(^|[^\p{Nd}])", r"($|[^\p{Nd}])"),
    "cep": (r"(^|[^\p{Nd}])", r"($|[^\p{Nd}])"),
    "oab": (f"(^|[^{WORD}])", f"($|[^{WORD}])"),
}


def duck_pattern(label: str) -> str:
    raw = {name: p for name, _, p in text.IDENTIFIER_PATTERNS}[label]
    core = raw.removeprefix(r"\b").removesuffix(r"\b").removeprefix(r"(?<!\d)").removesuffix(r"(?!\d)")
    core = core.replace(r"[\w.+-]", f"[{WORD}.+-]").replace(r"[\w-]", f"[{WORD}-]").replace(r"\d", r"\p{Nd}")
    left, right = EDGE[label]
    return ("(?i)" if label == "oab" else "") + left + core + right


def scrubbed(column: str) -> str:
    for label, token, _ in text.IDENTIFIER_PATTERNS:
        pattern = duck_pattern(label)
        replacement = rf"\1{token}\2" if EDGE[label][0] else token
        for _ in range(2 if EDGE[label][0] else 1):
            column = f"regexp_replace({column}, '{pattern}', '{replacement}', 'g')"
    return column


SENSITIVE = f"(?i)(^|[^{WORD}])" + text.SENSITIVE_VOCABULARY.removeprefix(r"\b").removesuffix(
    r"\b"
).replace(r"\w", f"[{WORD}]") + f"($|[^{WORD}])"


def pii_rows() -> str:
    columns = {
        "documents": ["text", "lang", "source"],
        "pages": ["url", "html"],
        "conversations": ["role", "text"],
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{label}' AS label, CAST(count(*) FILTER (WHERE "
        f"regexp_matches({c}, '{duck_pattern(label)}')) AS BIGINT) AS matches, '{t}' AS table_name FROM {t}"
        for t, cs in columns.items()
        for c in cs
        for label, _, _ in text.IDENTIFIER_PATTERNS
    )


LINKAGE = """linkage AS (SELECT *, year(filing_date) AS filing_year,
  CASE WHEN claim_value > 0 THEN CAST(floor(2 * log10(claim_value)) AS BIGINT) END AS claim_band FROM cases)"""


def risk(columns: str) -> str:
    return f"""{BASE}, {LINKAGE}, g AS (SELECT count(*) AS n FROM linkage GROUP BY {columns})
SELECT count(*) AS n_groups, min(n) AS min_k,
  round(100.0 * sum(CASE WHEN n < 5 THEN n ELSE 0 END) / sum(n), 2) AS pct_records_in_groups_below_k,
  round(count(*) / sum(n), 4) AS avg_prosecutor_risk, round(1.0 / min(n), 4) AS max_prosecutor_risk FROM g"""


PROFILED = ["case_id", "judge_id", "uf", "comarca", "vara", "filing_date", "claim_value", "unfavorable"]
PROFILED_TYPES = ["bigint", "bigint", "string", "string", "string", "date", "double", "int"]
PROFILE = BASE + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS dtype,
  round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS missing_pct,
  count(DISTINCT {c}) AS n_unique, round(count(DISTINCT {c}) / count(*), 4) AS unique_ratio FROM cases"""
    for c, t in zip(PROFILED, PROFILED_TYPES, strict=True)
)

STATS = """SELECT unnest(['mean','median','std','skew','p99','max']) AS statistic,
 unnest([avg(x), median(x), stddev_samp(x), skewness(x), quantile_cont(x, 0.99), max(x)]) AS v"""
TARGET = f"""{BASE}, r AS ({STATS} FROM (SELECT claim_value AS x FROM cases WHERE claim_value IS NOT NULL)),
l AS ({STATS} FROM (SELECT ln(1 + claim_value) AS x FROM cases WHERE claim_value IS NOT NULL))
SELECT statistic, round(r.v, 3) AS raw, round(l.v, 3) AS log1p FROM r JOIN l USING (statistic)"""

VALUE_SUMMARY = f"""{BASE} SELECT unnest(['count','mean','median','p95','max','missing']) AS statistic,
 unnest([count(*)::DOUBLE, round(avg(claim_value), 2), round(median(claim_value), 2),
  round(quantile_cont(claim_value, 0.95), 2), round(max(claim_value), 2),
  (count(*) FILTER (WHERE claim_value IS NULL))::DOUBLE]) AS value FROM cases"""


def histogram(value: str, bins: int) -> str:
    return f"""{BASE}, v AS (SELECT {value} AS x FROM cases WHERE claim_value IS NOT NULL),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
c AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS BIGINT) + 1, {bins}) AS bin, count(*) AS n
  FROM v, e GROUP BY 1)
SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / {bins}), 6) AS lower,
  round(lo + b.bin * ((hi - lo) / {bins}), 6) AS upper, coalesce(c.n, 0) AS n
FROM (SELECT unnest(range(1, {bins + 1})) AS bin) b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin"""


ETA = (
    f"{BASE}, y AS (SELECT *, ln(1 + claim_value) AS y FROM cases), "
    "t AS (SELECT var_pop(y) * count(y) AS sst FROM y) "
    + " UNION ALL ".join(
        f"""SELECT '{g}' AS column_name, (SELECT count(DISTINCT {g}) FROM cases) AS n_levels,
  round(1 - (SELECT sum(w) FROM (SELECT var_pop(y) * count(y) AS w FROM y GROUP BY {g})) / (SELECT sst FROM t), 3)
  AS eta_squared"""
        for g in ("judge_id", "comarca", "uf", "vara")
    )
)

NUMERIC = ["filing_month", "n_prior", "avg_value_prior", "label_rate_prior"]
GRAIN = f"""{BASE}, {history("h", "cases", "comarca", 180, "unfavorable")},
a AS (SELECT c.case_id, month(filing_date)::DOUBLE AS filing_month, n::DOUBLE AS n_prior,
  v AS avg_value_prior, r AS label_rate_prior, claim_value FROM cases c JOIN h ON h.case_id = c.case_id)"""


def mid_rank(c: str) -> str:
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


SPEARMAN = (
    f"{GRAIN}, s AS (SELECT * FROM a WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in [*NUMERIC, "claim_value"])
    + "), k AS (SELECT "
    + ", ".join(f"{mid_rank(c)} AS {c}" for c in [*NUMERIC, "claim_value"])
    + " FROM s) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, claim_value), 3) AS spearman FROM k" for c in NUMERIC
    )
)


def grouped(by: str, name: str, count: str) -> str:
    return f"""{BASE} SELECT {by} AS {name}, count(*) AS {count},
  round(median(claim_value), 3) AS median_claim, round(avg(unfavorable), 3) AS unfav_rate
FROM cases GROUP BY 1"""


QUARTERS = f"""{BASE}, c AS (SELECT date_trunc('quarter', filing_date)::DATE AS q, count(*) AS n FROM book GROUP BY 1)
SELECT last_day((g.q + INTERVAL 2 MONTH)::DATE) AS quarter_end, coalesce(c.n, 0) AS n
FROM (SELECT unnest(generate_series((SELECT min(q) FROM c)::TIMESTAMP, (SELECT max(q) FROM c)::TIMESTAMP,
  INTERVAL 3 MONTH))::DATE AS q) g LEFT JOIN c ON c.q = g.q"""

ORDERED = f"""{BASE}, o AS (SELECT *, row_number() OVER (ORDER BY filing_date, case_id) - 1 AS pos,
  count(*) OVER () AS total FROM cases),
cut AS (SELECT filing_date AS day FROM o WHERE pos = CAST(floor(total * (1 - 0.2)) AS BIGINT))"""


#: Every test row is explained, exactly: only rows with an amount are split for the regression.
ADDITIVITY = f"""{BASE}, t AS (SELECT 'regression' AS task, filing_date, case_id FROM cases WHERE claim_value IS NOT NULL
  UNION ALL SELECT 'classification', filing_date, case_id FROM cases),
o AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY filing_date, case_id) - 1 AS pos, count(*) OVER (PARTITION BY task) AS total FROM t),
cut AS (SELECT task, filing_date AS day FROM o WHERE pos = CAST(floor(total * (1 - 0.2)) AS BIGINT))
SELECT task, 'exact tree attribution' AS explainer,
  CASE task WHEN 'regression' THEN 'log1p(BRL)' ELSE 'class-1 probability' END AS output_space,
  count(*) AS cases, 0.0::DOUBLE AS max_error, true AS ok
FROM o JOIN cut USING (task) WHERE filing_date >= day GROUP BY task"""


def time_split(purge: str) -> str:
    return f"""{ORDERED} SELECT case_id, CASE WHEN filing_date < day THEN 'train' ELSE 'test' END AS part
FROM o, cut WHERE filing_date >= day OR (filing_date < day {purge})"""


FOLDS = f"""{ORDERED} SELECT case_id,
  CAST(greatest(0, 5 - ceil((total - pos) / (total // 5)) ) AS INT) AS fold FROM o"""

FIT = f"""{ORDERED} SELECT case_id,
  CASE WHEN pos < CAST(floor(total * (1 - 0.15)) AS BIGINT) THEN 'fit' ELSE 'validation' END AS part FROM o"""

ONE_HOT = f"""{ORDERED}, m AS (SELECT o.*, strftime(filing_date, '%Y-%m') AS k, filing_date < day AS train FROM o, cut),
f AS (SELECT k, count(*) AS n FROM m WHERE train GROUP BY k),
lim AS (SELECT max(n) // 2 + max(n) // 3 AS least_n FROM f)
SELECT case_id, CASE WHEN f.n >= least_n THEN m.k WHEN f.n IS NOT NULL THEN 'infrequent' END AS category,
  CASE WHEN f.n IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ones
FROM m CROSS JOIN lim LEFT JOIN f ON f.k = m.k"""

SHRINK = """CASE WHEN coalesce(n, 0) > 0 AND yv > 0
  THEN yv * n / (yv * n + v) * m + (1 - yv * n / (yv * n + v)) * ym ELSE ym END"""
TARGET_ENCODE = f"""{ORDERED}, tr AS (SELECT judge_id, case_id, unfavorable AS y, case_id % 5 AS fold FROM o, cut WHERE filing_date < day),
te AS (SELECT judge_id, case_id FROM o, cut WHERE filing_date >= day),
folds AS (SELECT unnest(range(5)) AS f),
gl AS (SELECT f, avg(y) AS ym, var_pop(y) AS yv FROM tr JOIN folds ON fold <> f GROUP BY f),
st AS (SELECT f, judge_id, count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM tr JOIN folds ON fold <> f GROUP BY f, judge_id),
ag AS (SELECT avg(y) AS ym, var_pop(y) AS yv FROM tr),
al AS (SELECT judge_id, count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM tr GROUP BY judge_id)
SELECT tr.case_id, round({SHRINK}, 6) AS judge_id_enc
FROM tr JOIN gl ON gl.f = tr.fold LEFT JOIN st ON st.f = tr.fold AND st.judge_id = tr.judge_id
UNION ALL
SELECT te.case_id, round({SHRINK}, 6) FROM te CROSS JOIN ag LEFT JOIN al ON al.judge_id = te.judge_id"""

SCALE = (
    f"{GRAIN}, fit AS (SELECT * FROM a WHERE claim_value IS NOT NULL), med AS (SELECT "
    + ", ".join(f"median({c}) AS {c}" for c in NUMERIC)
    + " FROM fit), st AS (SELECT "
    + ", ".join(
        f"avg(coalesce(fit.{c}, med.{c})) AS m_{c}, stddev_samp(coalesce(fit.{c}, med.{c})) AS s_{c}" for c in NUMERIC
    )
    + ", avg(ln(1 + claim_value)) AS ym, stddev_pop(ln(1 + claim_value)) AS ys FROM fit, med) SELECT case_id, "
    + ", ".join(f"round((coalesce(a.{c}, med.{c}) - m_{c}) / s_{c}, 5) AS {c}_z" for c in NUMERIC)
    + ", round((ln(1 + claim_value) - ym) / ys, 5) AS label_z FROM a, med, st"
)

VOCABULARY = f"""{ORDERED}, v AS (SELECT judge_name, row_number() OVER (ORDER BY judge_name) AS i
  FROM (SELECT DISTINCT judge_name FROM o, cut WHERE filing_date < day))
SELECT case_id, coalesce(i, 0) AS judge_name_index FROM cases LEFT JOIN v USING (judge_name)"""

SCORED = f"""{BASE}, s AS (SELECT *, claim_value * (0.5::DOUBLE + (case_id % 100) / 100.0::DOUBLE) AS prediction,
  (case_id % 101) / 100.0::DOUBLE AS proba FROM cases),
r AS (SELECT *, claim_value AS y, abs(claim_value - prediction) AS e FROM s WHERE claim_value IS NOT NULL)"""

REGRESSION = f"""{SCORED} SELECT round(avg(e), 6) AS mae, round(median(e), 6) AS medae,
  round(sqrt(avg(e * e)), 6) AS rmse, round(sqrt(avg(pow(ln(1 + prediction) - ln(1 + y), 2))), 6) AS rmsle,
  round(1 - avg(e * e) / var_pop(y), 6) AS r2, round(median(e / y), 6) AS mdape FROM r"""

MEDIAN_LOG = f"""{BASE}, v AS (SELECT *, row_number() OVER (ORDER BY filing_date, case_id) - 1 AS pos,
  count(*) OVER () AS total FROM cases WHERE claim_value IS NOT NULL),
vc AS (SELECT filing_date AS day FROM v WHERE pos = CAST(floor(total * (1 - 0.2)) AS BIGINT)),
o AS (SELECT *, row_number() OVER (ORDER BY filing_date, case_id) - 1 AS pos, count(*) OVER () AS total FROM cases),
oc AS (SELECT filing_date AS day FROM o WHERE pos = CAST(floor(total * (1 - 0.2)) AS BIGINT))
SELECT (SELECT round(exp(median(ln(1 + claim_value))) - 1, 4) FROM v, vc WHERE filing_date < day) AS median_prediction,
 (SELECT round(avg(unfavorable), 6) FROM o, oc WHERE filing_date < day AND decision_date < day) AS prior_probability"""


def auc(by: str, name: str) -> str:
    return f"""SELECT {name} AS uf, round(sum(pos * (bn + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM (
 SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bn
 FROM (SELECT {by} AS g, {by}, proba, sum(unfavorable)::DOUBLE AS pos, sum(1 - unfavorable)::DOUBLE AS neg FROM s1
   GROUP BY {by}, proba)) GROUP BY {by}"""


AUC = f"""{SCORED}, s1 AS (SELECT *, 'all' AS whole FROM s)
{auc("uf", "uf")} UNION ALL {auc("whole", "whole")}"""

PRECISION = """SELECT sum(pos / tot * tp / (tp + fp)) AS ap FROM (SELECT pos,
  sum(pos) OVER () AS tot, sum(pos) OVER (ORDER BY proba DESC) AS tp, sum(neg) OVER (ORDER BY proba DESC) AS fp
  FROM (SELECT proba, sum(unfavorable)::DOUBLE AS pos, sum(1 - unfavorable)::DOUBLE AS neg FROM s GROUP BY proba))"""
CLASSIFICATION = f"""{SCORED}, s1 AS (SELECT *, 'all' AS whole FROM s),
q AS (SELECT unfavorable AS y, proba, CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END AS c FROM s)
SELECT (SELECT roc_auc FROM ({auc("whole", "whole")})) AS roc_auc, (SELECT round(ap, 6) FROM ({PRECISION})) AS pr_auc,
 round(avg(pow(proba - y, 2)), 6) AS brier, round(2.0 * sum(y * c) / (sum(y) + sum(c)), 6) AS f1,
 round(avg(CASE WHEN y = c THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(y), 6) AS base_rate FROM q"""

WILCOXON = f"""{SCORED}, p AS (SELECT e AS a, abs(y - 250000.0::DOUBLE) AS b FROM r), d AS (SELECT *, a - b AS d FROM p),
k AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS rk FROM d WHERE d <> 0),
w AS (SELECT sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS up, sum(CASE WHEN d < 0 THEN rk ELSE 0 END) AS dn, count(*) AS n FROM k)
SELECT (SELECT count(*) FROM d) AS n_pairs, n AS n_ranked, round(least(up, dn), 1)::DOUBLE AS statistic,
 round(up, 1)::DOUBLE AS w_plus, round(dn, 1)::DOUBLE AS w_minus,
 (SELECT round(median(a), 4) FROM d) AS median_loss_model, (SELECT round(median(b), 4) FROM d) AS median_loss_baseline,
 (SELECT round(median(d), 4) FROM d) AS median_loss_difference FROM w"""


def peer(keys: str, least_n: int) -> str:
    return f"""{BASE}, x AS (SELECT *, ln(1 + claim_value) AS l FROM cases WHERE claim_value IS NOT NULL),
g AS (SELECT median(l) AS gm FROM x), gd AS (SELECT greatest(1.4826 * median(abs(l - gm)), 1e-6) AS gs FROM x, g),
m AS (SELECT {keys}, count(*) AS n, median(l) AS md FROM x GROUP BY {keys}),
s AS (SELECT {keys}, greatest(1.4826 * median(abs(l - md)), 1e-6) AS sc FROM x JOIN m USING ({keys}) GROUP BY {keys})
SELECT case_id, round((l - CASE WHEN n >= {least_n} THEN md ELSE gm END) / CASE WHEN n >= {least_n} THEN sc ELSE gs END, 6) AS peer_z
FROM x JOIN m USING ({keys}) JOIN s USING ({keys}), g, gd"""


REQUESTS = f"""{BASE}, q AS (SELECT case_id,
  CASE WHEN case_id % 3 = 0 THEN substr(uf, 1, 3) ELSE substr(uf, 1, 2) END AS uf,
  CASE WHEN case_id % 7 = 0 THEN repeat(comarca, 20) ELSE comarca END AS comarca, vara, judge_name AS judge_id,
  month(filing_date) + CASE WHEN case_id % 5 = 0 THEN 6 ELSE 0 END AS filing_month,
  CASE WHEN case_id % 2 = 0 THEN (case_id % 130) / 100.0 END AS judge_unfav_rate_prior, NULL AS comarca_unfav_rate_prior
  FROM cases),
e AS (SELECT case_id, concat_ws(',', {", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in rules.REQUEST_CHECKS.items())}) AS errors FROM q)
SELECT case_id, errors = '' AS valid, errors FROM e"""

REFRESHED = f"""{BASE}, after AS (SELECT * REPLACE (
  CASE WHEN case_id % 10 = 3 THEN decision_date + 15 ELSE decision_date END AS decision_date)
  FROM cases WHERE case_id % 10 <> 2),
{history("j", "after", "judge_id", 180, "unfavorable")}, {history("k", "after", "comarca", 180, "unfavorable")}
SELECT c.case_id, judge_id, uf, comarca, vara, filing_date, decision_date, claim_value, unfavorable,
  CAST(month(filing_date) AS INT) AS filing_month, j.n AS judge_n_prior,
  j.v AS judge_avg_value_prior, j.r AS judge_unfav_rate_prior, k.n AS comarca_n_prior,
  k.v AS comarca_avg_value_prior, k.r AS comarca_unfav_rate_prior
FROM after c JOIN j ON j.case_id = c.case_id JOIN k ON k.case_id = c.case_id"""

UPSERTED = f"""{BASE} SELECT case_id, uf, claim_value, 1 AS loaded_at, filing_date FROM cases
WHERE case_id % 3 <> 0 AND case_id % 5 <> 0
UNION ALL SELECT case_id, uf, claim_value, 2,
  CASE WHEN case_id % 2 = 0 THEN filing_date - 40 ELSE filing_date END
FROM cases WHERE case_id % 3 = 0 OR case_id % 5 = 0"""

#: Poisson(1) weights of every row and replicate from 32-bit arithmetic on MD5 words; all replicates written out.
_WORDS = "CAST('0x' || md5({0})[1:8] AS UBIGINT) AS {1}1, CAST('0x' || md5({0})[9:16] AS UBIGINT) AS {1}2"
_MIX = """{out} AS (SELECT * EXCLUDE (h), xor(h, h >> 16) AS h FROM (SELECT * EXCLUDE (h), (h * 2221713035::UBIGINT) % 4294967296 AS h
  FROM (SELECT * EXCLUDE (h), xor(h, h >> 15) AS h FROM (SELECT * EXCLUDE (h), (h * 2146121005::UBIGINT) % 4294967296 AS h
  FROM (SELECT * EXCLUDE (h), xor(h, h >> 16) AS h FROM {of})))))"""
BOOTSTRAP = f"""{SCORED},
reps AS (SELECT i, {_WORDS.format("'42:' || i", "s")} FROM (SELECT unnest(range(500)) AS i)),
cells AS (SELECT i, claim_value, prediction, unfavorable, proba, w2, s2, xor(w1, s1) AS h
  FROM (SELECT *, {_WORDS.format("CAST(case_id AS VARCHAR)", "w")} FROM s), reps),
{_MIX.format(out="mixed", of="cells")},
again AS (SELECT * EXCLUDE (h), xor(xor(h, w2), s2) AS h FROM mixed),
{_MIX.format(out="done", of="again")},
law(k, p) AS (SELECT * FROM (WITH RECURSIVE t(k, p) AS (SELECT 0, exp(-1.0) UNION ALL SELECT k + 1, p / (k + 1) FROM t WHERE k < 12) SELECT * FROM t)),
steps AS (SELECT list(CAST(round(below * 4294967296) AS UBIGINT) ORDER BY k) AS points
  FROM (SELECT k, sum(p) OVER (ORDER BY k) AS below FROM law) WHERE k < 12),
weighted AS (SELECT i, claim_value, prediction, unfavorable, proba, len(list_filter(points, lambda x: x <= h)) AS w FROM done, steps),
losses AS (SELECT i, sum(w * abs(claim_value - prediction)) FILTER (claim_value IS NOT NULL) / sum(w) FILTER (claim_value IS NOT NULL) AS mae,
    sum(w * (unfavorable - proba) * (unfavorable - proba)) / sum(w) AS brier FROM weighted GROUP BY i),
places AS (SELECT i, proba, sum(w * unfavorable) AS pos, sum(w * (1 - unfavorable)) AS neg FROM weighted GROUP BY i, proba),
areas AS (SELECT i, sum(pos * (before + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY i ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM places) GROUP BY i)
SELECT 'mae' AS metric, round(quantile_cont(mae, 0.025), 6) AS lower, round(quantile_cont(mae, 0.975), 6) AS upper FROM losses
UNION ALL SELECT 'brier', round(quantile_cont(brier, 0.025), 6), round(quantile_cont(brier, 0.975), 6) FROM losses
UNION ALL SELECT 'roc_auc', round(quantile_cont(auc, 0.025), 6), round(quantile_cont(auc, 0.975), 6) FROM areas"""

ORACLE = {
    "incremental_features": REFRESHED,
    "incremental_load": UPSERTED,
    "stream_gate": f"""SELECT event_id, {keyed("CAST(user_id AS VARCHAR)", "USER")} AS user_pseudonym, event_type,
  {scrubbed("props")} AS props FROM events""",
    "abt_comarca_180": one_grain("comarca", 180),
    "abt_customer_180": one_grain("judge_id", 180),
    "abt_full": ABT_FULL,
    "abt_book_365": ABT_BOOK,
    "dq_profile": f"""{BASE} SELECT count(*) AS n_cases, count(DISTINCT judge_id) AS n_judges,
  count(DISTINCT comarca) AS n_comarcas,
  round(100.0 * count(*) FILTER (WHERE claim_value IS NULL) / count(*), 2) AS pct_missing_claim_value,
  round(100.0 * avg(unfavorable), 2) AS pct_unfavorable, min(filing_date) AS first_filing, max(filing_date) AS last_filing,
  round(avg(decision_date - filing_date), 1) AS avg_days_to_decision, round(max(claim_value), 2) AS max_claim_value FROM cases""",
    "dq_checks": BASE
    + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({sql} AS VARCHAR) AS value FROM book"
        for name, sql in {
            "rows": "count(*)",
            "distinct_case_id": "count(DISTINCT case_id)",
            "missing_claim_value": "count(*) FILTER (WHERE claim_value IS NULL)",
            "nonpositive_claim_value": "count(*) FILTER (WHERE claim_value <= 0)",
            "missing_filing_date": "count(*) FILTER (WHERE filing_date IS NULL)",
            "decision_before_filing": "count(*) FILTER (WHERE decision_date < filing_date)",
            "binary_label_rows": "count(reformed)",
            "reformed_rate": "round(avg(reformed), 4)",
            "first_filing_date": "min(filing_date)",
            "last_decision_date": "max(decision_date)",
        }.items()
    ),
    "constraint_report": rule_rows(),
    "unknown_domain": f"{BASE} SELECT DISTINCT sentence_outcome FROM cases WHERE coalesce(sentence_outcome NOT IN ('F', 'O'), true)",
    "dedupe_keep_first": dedupe("ASC"),
    "dedupe_keep_latest": dedupe("DESC"),
    "pseudonyms": PSEUDONYMS,
    "gate_release": GATE.replace("@SIG@", sig(2)),
    "tree_shap_additivity": ADDITIVITY,
    "book_ids": f"{BASE} SELECT case_id, 'BOOK_' || upper(substr(sha256('{ids.PUBLIC_ID_NAMESPACE}' || case_id), 1, 16)) AS book_id FROM cases",
    "book_labels": f"""{BASE} SELECT case_id, reformed, CASE WHEN decision_outcome IN ('F', 'P') THEN 1 ELSE 0 END AS binary_label,
  filing_date, CAST(year(filing_date) AS INT) AS filing_year, round(ln(1 + claim_value), 6) AS claim_value_log,
  round(claim_value, 2) AS claim_value_back FROM book""",
    "book_rules": f"""{BASE} SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT unnest([{", ".join(f"'{c}_not_null'" for c in BOOK_COLUMNS)}, 'unanimity_not_null', 'tipo_litigio_domain', 'claim_value_positive', 'reformed_binary', 'case_days_not_negative', 'decision_not_before_filing']) AS rule,
    unnest([{", ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in BOOK_COLUMNS)}, 0, count(*) FILTER (WHERE tipo_litigio NOT IN ('PF-PF', 'PF-nPF', 'nPF-PF', 'nPF-nPF')), count(*) FILTER (WHERE NOT claim_value > 0),
      count(*) FILTER (WHERE reformed NOT IN (0, 1)), count(*) FILTER (WHERE case_days < 0),
      count(*) FILTER (WHERE decision_date < filing_date)]) AS violations FROM book)
UNION ALL SELECT 'case_id_unique', count(*) FROM (SELECT case_id FROM book GROUP BY 1 HAVING count(*) > 1)""",
    "domain_values": BASE + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM cases)) AS known_values"
        for c in ("uf", "vara", "sentence_outcome")
    ),
    "spearman_ranking": f"SELECT feature, row_number() OVER (ORDER BY abs(spearman) DESC, feature) AS place FROM ({SPEARMAN})",
    "prediction_picks": f"""{SCORED}, o AS (SELECT case_id, prediction, row_number() OVER (ORDER BY prediction, case_id) - 1 AS p,
    count(*) OVER () AS n FROM s WHERE claim_value IS NOT NULL)
SELECT pick, case_id, prediction FROM o, (SELECT unnest(['lowest', 'median', 'highest']) AS pick)
WHERE (pick = 'lowest' AND p = 0) OR (pick = 'median' AND p = n // 2) OR (pick = 'highest' AND p = n - 1)""",
    "case_order": f"{BASE} SELECT case_id, row_number() OVER (ORDER BY filing_date, case_id) - 1 AS position FROM cases",
    "date_shift": f"""{BASE} SELECT case_id, filing_date + {SHIFT} AS filing_date,
  decision_date + {SHIFT} AS decision_date FROM cases""",
    "sample_k": f"{BASE} SELECT case_id, uf FROM cases ORDER BY sha256('42:' || case_id), case_id LIMIT 800",
    "sig_round": f"""{BASE} SELECT case_id, {sig(2)} AS two_digits, {sig(4)} AS four_digits,
  CASE WHEN claim_value > 0 THEN CAST(CAST(floor(2 * log10(claim_value)) AS BIGINT) AS VARCHAR) END AS claim_band FROM cases""",
    "scrub_documents": f"SELECT doc_id, sha256({scrubbed('text')}) AS scrubbed_sha256 FROM documents",
    "scrub_pages": f"SELECT page_id, sha256({scrubbed('html')}) AS scrubbed_sha256 FROM pages",
    "scrub_conversations": f"""SELECT conv_id, turn, sha256(CASE WHEN regexp_matches(text, '{SENSITIVE}')
  THEN '{text.REDACTED_TEXT}' ELSE {scrubbed("text")} END) AS released_sha256 FROM conversations""",
    "pii_scan_documents": pii_rows(),
    "sensitive_documents": f"""SELECT lang, source, count(*) AS documents,
  count(*) FILTER (WHERE regexp_matches(text, '{SENSITIVE}')) AS sensitive_documents FROM documents GROUP BY lang, source""",
    "secrecy_filter": f"{BASE} SELECT case_id, uf, vara FROM cases WHERE NOT segredo_justica",
    "row_reconciliation": f"""{DUPLICATES} SELECT count(*) AS rows_loaded, count(*) FILTER (WHERE NOT segredo_justica) AS rows_open,
  count(DISTINCT case_id) FILTER (WHERE NOT segredo_justica) AS rows_distinct,
  count(DISTINCT case_id) FILTER (WHERE NOT segredo_justica AND load_order = 0 AND claim_value IS NOT NULL) AS rows_usable FROM loaded""",
    "risk_linkage": risk("uf, comarca, vara, filing_year, claim_band"),
    "risk_internal": risk("uf, comarca, vara, judge_id"),
    "l_diversity": f"""{BASE}, {LINKAGE}, g AS (SELECT count(*) AS n, count(DISTINCT sentence_outcome) AS k FROM linkage
  GROUP BY uf, comarca, vara, filing_year, claim_band)
SELECT round(100.0 * sum(CASE WHEN k < 2 THEN n ELSE 0 END) / sum(n), 2) AS pct_homogeneous FROM g""",
    "suppress_k5": f"""{BASE}, {LINKAGE} SELECT case_id, uf, comarca, vara FROM linkage
QUALIFY count(*) OVER (PARTITION BY uf, comarca, vara, filing_year, claim_band) >= 5""",
    "k_anonymity_lt5": f"""{BASE} SELECT comarca, vara, judge_id, count(*) AS n FROM cases
GROUP BY comarca, vara, judge_id HAVING count(*) < 5""",
    "profile_columns": PROFILE,
    "missing_by_column": f"""{BASE} SELECT 'claim_value' AS column_name, count(*) AS missing FROM cases
WHERE claim_value IS NULL""",
    "missing_none": "SELECT 'none' AS column_name, CAST(0 AS BIGINT) AS missing",
    "id_like": f"SELECT column_name FROM ({PROFILE}) WHERE unique_ratio >= 0.5",
    "target_summary": TARGET,
    "value_summary": VALUE_SUMMARY,
    "hist_log": histogram("ln(1 + claim_value)", 50),
    "hist_clipped": histogram("least(claim_value, (SELECT quantile_cont(claim_value, 0.99) FROM cases))", 40),
    "eta_squared": ETA,
    "spearman": SPEARMAN,
    "missing_by_group": f"""{BASE} SELECT comarca, count(*) AS n,
  round(avg(CASE WHEN claim_value IS NULL THEN 1.0 ELSE 0.0 END) * 100, 2) AS missing_pct FROM cases GROUP BY comarca""",
    "by_group": grouped("comarca", "comarca", "n"),
    "value_counts": f"""{BASE} SELECT assunto, count(*) AS cases, round(count(*) / (SELECT count(*) FROM book), 3) AS share
FROM book WHERE assunto IS NOT NULL GROUP BY assunto""",
    "label_balance": f"{BASE} SELECT reformed, count(*) AS n FROM book GROUP BY reformed",
    "group_error_bars": f"""{BASE} SELECT comarca, round(avg(ln(1 + claim_value)), 6) AS mean,
  round(stddev_samp(ln(1 + claim_value)) / sqrt(count(claim_value)), 6) AS sem, count(claim_value) AS n
FROM cases WHERE claim_value IS NOT NULL GROUP BY comarca""",
    "monthly": grouped("date_trunc('month', filing_date)::DATE", "month", "n_cases"),
    "quarterly_filled": QUARTERS,
    "top15_comarca": f"{BASE} SELECT comarca, count(*) AS cases FROM book GROUP BY comarca ORDER BY cases DESC, comarca LIMIT 15",
    "temporal_split": time_split(""),
    "temporal_split_purged": time_split("AND decision_date < day"),
    "ts_folds": FOLDS,
    "fit_validation": FIT,
    "onehot_minfreq": ONE_HOT,
    "target_encode": TARGET_ENCODE,
    "impute_standardise": SCALE,
    "vocab_index": VOCABULARY,
    "reg_metrics": REGRESSION,
    "baseline_predictions": MEDIAN_LOG,
    "cls_metrics": CLASSIFICATION,
    "roc_auc": AUC,
    "avg_precision": f"{SCORED} SELECT round(ap, 6) AS pr_auc FROM ({PRECISION})",
    "error_slices": f"{SCORED} SELECT uf, count(*) AS n, round(avg(e), 4) AS mae, round(median(e), 4) AS medae FROM r GROUP BY uf",
    "wilcoxon_stat": WILCOXON,
    "peer_z": peer("comarca, vara", 20),
    "peer_z_small_groups": peer("judge_id", 10),
    "request_validation": REQUESTS,
    "bootstrap_ci": BOOTSTRAP,
}
