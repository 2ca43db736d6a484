"""The queries of this package and the SQL some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, embeddings, licenses, mixing, negatives, orc_tokens, personal, quality, secrets, simhash, substrings, url_filters, vector_codes
from .words import table

# Rank file and pattern; vocabulary of the token files.
BYTE_BPE = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ORC_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query(r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM a)),
rep AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN rep USING (doc_id, g), (SELECT unnest(range(0, 5)) AS k)),
cov AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
m AS (SELECT a.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             len(lines)::BIGINT AS n_lines,
             (length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')))::BIGINT AS n_capitals
      FROM a LEFT JOIN cov ON a.doc_id = cov.doc_id),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
               + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
               + CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END
               + CASE WHEN 100 * n_capitals > 30 * word_chars THEN 8 ELSE 0 END
               + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 16 ELSE 0 END
               + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT *, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, 'v2' AS policy FROM f
""")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, failed rules and verdict under the current policy."""
    return quality.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secret spans of every document."""
    return secrets.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.report(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), *BYTE_BPE)


@query()
def op9_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the ORC files."""
    return orc_tokens.roundtrip(table(spark, sf_dir, "documents", "doc_id", "text"), ORC_VOCABULARY)


def _licence_sql() -> str:
    """The same tables, as lists and patterns of the other engine."""
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in licenses.KNOWN.items())
    parts = [f"""
known(sentence, name) AS (VALUES {known}),
s AS (SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) AS i
      FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\n+|[.!?]+[\x20\x09-\x0D]+') AS x FROM documents)),
k AS (SELECT doc_id, string_agg(name, ',' ORDER BY i) AS sentences, string_agg('<' || name || '>', '' ORDER BY i) AS left0,
             count(*) AS n_sentences
      FROM (SELECT doc_id, i, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM s) JOIN known USING (sentence)
      GROUP BY doc_id),
r0 AS (SELECT *, []::VARCHAR[] AS found0 FROM k)"""]
    for i, rule in enumerate(licenses.ORDER):
        p, rest = licenses.pattern(rule), licenses.remainder(rule).replace("$", "\\")
        parts.append(f"""
r{i + 1} AS (SELECT doc_id, sentences, n_sentences, regexp_replace(left{i}, '{p}', '{rest}', 'g') AS left{i + 1},
  CASE WHEN regexp_matches(left{i}, '{p}') AND NOT list_contains(found{i}, '{rule.licence}')
       THEN list_append(found{i}, '{rule.licence}') ELSE found{i} END AS found{i + 1} FROM r{i})""")
    n = len(licenses.ORDER)
    return "WITH " + ",".join(parts) + f"""
SELECT d.doc_id, coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(sentences, '') AS sentences,
       coalesce(array_to_string(found{n}, ','), '') AS licences
FROM documents d LEFT JOIN r{n} r ON r.doc_id = d.doc_id"""


@query(_licence_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence sentences and licences of every document."""
    return licenses.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return url_filters.report(table(spark, sf_dir, "pages", "page_id", "url"))


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return simhash.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to passages of smaller documents."""
    return substrings.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id) LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) ON a = vec_id
""")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return embeddings.report(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def _codes_sql() -> str:
    """Every part measured against every entry, ``ROUNDS`` times and once more."""
    parts = ["""
v AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, e[part * len(e) // 16 + 1:(part + 1) * len(e) // 16] AS x
      FROM v, (SELECT unnest(range(0, 16)) AS part)),
c0 AS (SELECT part, entry, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (vec_id)
       WHERE entry < 64)"""]
    for i in range(vector_codes.ROUNDS + 1):
        parts.append(f"""
a{i} AS (SELECT vec_id, part, any_value(label) AS label, any_value(p.x) AS x,
                min(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + entry) AS d
         FROM p JOIN c{i} c USING (part) GROUP BY vec_id, part)""")
        if i < vector_codes.ROUNDS:
            parts.append(f"""
m{i} AS (SELECT part, entry, list(y ORDER BY place) AS x
         FROM (SELECT part, entry, place, floor(sum(y) / count(*))::BIGINT AS y
               FROM (SELECT part, d % 64 AS entry, unnest(x) AS y, generate_subscripts(x, 1) AS place FROM a{i})
               GROUP BY part, entry, place) GROUP BY part, entry),
c{i + 1} AS (SELECT part, entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (part, entry))""")
    n = vector_codes.ROUNDS
    return "WITH " + ",".join(parts) + f""",
r AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', d % 64), '' ORDER BY part) AS code,
             sum(d // 64)::BIGINT AS error FROM a{n} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{n})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM r, h"""


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error under codebooks of its table."""
    return vector_codes.report(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return negatives.report(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    return personal.report(table(spark, sf_dir, "documents", "doc_id", "text"))
