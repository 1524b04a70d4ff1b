"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    lexical_search,
    line_dedup,
    packing,
    quality,
    secrets,
    setsketch,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from flowgauge.llm.common import ship, table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.tiktoken"

QUERIES = {}
ORACLE = {}


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_TOKENIZER))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op5_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), vocabulary(WORD_TOKENIZER))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_counts(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), often AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.keeper AS gone
    FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS t(k) WHERE len(w) >= k)
), f AS (
    SELECT lang, k, phrase, count(*)::HUGEINT AS a, string_split(phrase, ' ') AS w
    FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS covered
    FROM (SELECT lang, k, w, a, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 5) AS t(m) WHERE m < k)
    GROUP BY 1, 2
), cuts AS (
    SELECT f.lang, f.phrase, f.a, x.a AS l, y.a AS r, n, c, (1000 * f.a * n) // (x.a * y.a) AS score
    FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1) f
    JOIN f x ON x.lang = f.lang AND x.phrase = array_to_string(f.w[1:f.c], ' ')
    JOIN f y ON y.lang = f.lang AND y.phrase = array_to_string(f.w[f.c + 1:f.k], ' ')
    JOIN totals ON totals.lang = f.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.covered IS NULL OR 100 * i.covered < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
impacts AS (
    SELECT t.doc_id, t.term,
           floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
           * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS impact
    FROM tfs t JOIN dfs USING (term) JOIN sizes USING (doc_id), corpus
), scores AS (
    SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""
