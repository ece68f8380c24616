"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitlake.llm import collocations, decontaminate, embeddings, jaccard, language_model, quality, quality_rules, secrets, token_counts, tokenfile, toxicity, transducer, variants, vocabulary
from pitlake.llm.common import read


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(read(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return transducer.report(read(spark, folder, "documents"), vocabulary.public_path(vocabulary.WORD_BPE))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.joined(read(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op6_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.report(read(spark, folder, "documents"), vocabulary.public_path(vocabulary.BYTE_BPE))


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.report(read(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.report(read(spark, folder, "documents"), vocabulary.public_path(vocabulary.BYTE_BPE))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, folder, "embeddings"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.report(read(spark, folder, "documents"))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.report(read(spark, folder, "documents"))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.report(read(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_toxicity,
        op3_bpe_round_trip,
        op4_ngram_jaccard_join,
        op5_decontamination,
        op6_token_id_output,
        op7_lm_scoring,
        op8_token_counts,
        op9_quality,
        op10_embedding_near_dedup,
        op11_spelling_variants,
        op12_quality_rules,
        op13_phrase_collocations,
    )
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str, pattern: str) -> str:
    return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}') AS w FROM {table}"""


#: Smallest vertex that each vertex reaches over ``links`` (a, b), both ways, or itself.
REACHED = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)"""

NEAR_TEXTS = rf"""
WITH RECURSIVE d AS ({_words("documents", "doc_id", "[^\x20\x09-\x0D]+")}),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
{REACHED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = d.doc_id"""

LEAKS = rf"""
WITH d AS ({_words("documents", "doc_id", "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}),
items AS ({_words("benchmark", "item_id", "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, i, runs.size FROM runs JOIN windows ON windows.g = runs.g AND windows.size = runs.size),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
met AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places ON places.doc_id = d.doc_id LEFT JOIN met ON met.doc_id = d.doc_id"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, x FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.95),
{REACHED}
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(low, v.vec_id)) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = v.vec_id"""

#: Words of 7 letters and more; a run loses one letter if 31 divides the CRC-32 of its document's id and itself.
VARIANTS = r"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents),
counted AS (SELECT doc_id, word, count(*) AS k FROM runs WHERE len(word) >= 7 GROUP BY ALL),
codes AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
keyed AS (SELECT word, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || word)) AS h FROM counted),
summed AS (SELECT word, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i : i + 1] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS crc FROM keyed, codes),
cut AS (SELECT k, CASE WHEN crc % 31 = 0 THEN word[1 : crc % len(word)] || word[crc % len(word) + 2 :] ELSE word END AS word FROM summed),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE len(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
holes AS (SELECT word, n, word[1 : i - 1] || '*' || word[i + 1 :] AS hole, word[1 : i - 1] || word[i + 1 :] AS less
  FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
dropped AS (SELECT DISTINCT word, n, less FROM holes),
near AS (SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.hole = y.hole AND x.word <> y.word
  UNION SELECT d.word, v.word, v.n FROM dropped d JOIN v ON v.word = d.less
  UNION SELECT v.word, d.word, d.n FROM dropped d JOIN v ON v.word = d.less),
best AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * v.n THEN other END AS form,
  CASE WHEN best.n >= 10 * v.n THEN best.n END AS form_n FROM v LEFT JOIN best USING (word)),
up(word, top) AS (SELECT word, word FROM forms UNION ALL SELECT up.word, f.form FROM up JOIN forms f ON f.word = up.top AND f.form IS NOT NULL)
SELECT forms.word, forms.form, up.top AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN up USING (word) JOIN forms last ON last.word = up.top AND last.form IS NULL"""

PHRASES = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, a, n, cut, l.f AS l, r.f AS r,
    (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN total USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1 :], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT DISTINCT lang, a AS longer, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
kept AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM parts WHERE parts.lang = low.lang AND parts.phrase = low.phrase AND 100 * longer >= 100 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

#: The other queries need code-point offsets, library results or trained models; tests hold them against brute force.
SQL = {
    "op4_ngram_jaccard_join": NEAR_TEXTS,
    "op5_decontamination": LEAKS,
    "op10_embedding_near_dedup": NEAR_VECTORS,
    "op11_spelling_variants": VARIANTS,
    "op13_phrase_collocations": PHRASES,
}
