"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statement_lake.llm import (
    divergence, fill_in_middle, html_extraction, language, language_model, mixture, near_duplicates,
    neighbours, packing, personal_data, secret_scan, top_k, warc,
)
from statement_lake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

def asked() -> Column:
    """The query set of both searches, as the task states it."""
    return F.col("vec_id") % 20 == 0



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, folder, "embeddings"), asked())


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return packing.best_fit(documents, public_tokenizers.path(packing.TOKENIZER))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    manifest = warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(manifest, archives).drop("url")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = language.held_out()
    found = language.identify(documents, ~held_out)
    return found.withColumn("held_out", held_out)


def op5_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, folder, "documents"))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_texts(table(spark, folder, "documents"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, folder, "documents"))


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), asked())


def op10_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    found = mixture.mix(table(spark, folder, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), *mixture.LEVELS, "tokens", "epoch")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(table(spark, folder, "pages"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, folder, "documents"))
    return fill_in_middle.restore(cut).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_warc": op3_warc,
        "op4_language_id": op4_language_id,
        "op5_simhash_near_duplicates": op5_simhash_near_duplicates,
        "op6_secret_scan": op6_secret_scan,
        "op7_language_model": op7_language_model,
        "op8_personal_data": op8_personal_data,
        "op9_nearest_neighbours": op9_nearest_neighbours,
        "op10_source_mixture": op10_source_mixture,
        "op11_source_divergence": op11_source_divergence,
        "op12_html_extraction": op12_html_extraction,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


OP1 = """
WITH coded AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS codes
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.codes, c.codes) AS BIGINT) AS score,
         row_number() OVER (
           PARTITION BY q.vec_id
           ORDER BY list_inner_product(q.codes, c.codes) DESC, c.vec_id) AS place
  FROM coded q JOIN coded c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

OP3 = """
WITH summed AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         CAST(from_hex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
           + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INTEGER)
           + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INTEGER)
           + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INTEGER)
           + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INTEGER)
           + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INTEGER) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM summed
"""

#: Water-filling of one level; the same for each.
LEVEL = """
{nodes} AS (
  SELECT {own}, CAST(sum(tokens) * 2 AS HUGEINT) AS capacity, any_value({weight}) AS weight
  FROM leaves GROUP BY {own}
), {nodes}_placed AS (
  SELECT n.*, p.budget AS above,
         coalesce(sum(capacity) OVER (PARTITION BY {inner} ORDER BY capacity / weight, n.{level}
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (PARTITION BY {inner} ORDER BY capacity / weight, n.{level}
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM {nodes} n JOIN {above} p ON {on}
), {nodes}_full AS (
  SELECT *, capacity * after <= weight * (above - before) AS is_full FROM {nodes}_placed
), {nodes}_budget AS (
  SELECT {own}, CASE WHEN is_full THEN capacity ELSE least(capacity,
           (weight * (above - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY {parts})))
           // sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER (PARTITION BY {parts})) END AS budget
  FROM {nodes}_full
)"""

DOMAIN_WEIGHT = "CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END"
LANG_WEIGHT = "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END"

OP10 = (
    """
WITH RECURSIVE read AS (
  SELECT doc_id, coalesce(lang, '-') AS lang, coalesce(source, '-') AS source,
         list_extract(['web', 'books', 'code', 'forum'],
           1 + coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS INTEGER), 0) % 4) AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
         coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, '')) AS name
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens) AS tokens FROM read GROUP BY ALL HAVING sum(tokens) > 0
), root AS (
  SELECT CAST(sum(tokens) * 50 // 100 AS HUGEINT) AS budget FROM leaves
), """
    + LEVEL.format(nodes="domains", own="domain", weight=DOMAIN_WEIGHT, parts="1", inner="1", level="domain", above="root", on="true")
    + ", "
    + LEVEL.format(nodes="langs", own="domain, lang", weight=LANG_WEIGHT, parts="domain", inner="n.domain", level="lang",
                   above="domains_budget", on="n.domain = p.domain")
    + ", "
    + LEVEL.format(nodes="sources", own="domain, lang, source", weight="1", parts="domain, lang", inner="n.domain, n.lang", level="source",
                   above="langs_budget", on="n.domain = p.domain AND n.lang = p.lang")
    + """, dealt AS (
  SELECT l.*, CAST(b.budget // l.tokens AS INTEGER) AS whole, b.budget % l.tokens AS rest
  FROM leaves l JOIN sources_budget b USING (domain, lang, source)
), run AS (
  SELECT r.*, d.whole, d.rest,
         sum(r.tokens) OVER (PARTITION BY r.domain, r.lang, r.source
           ORDER BY md5('17:' || d.whole || ':' || r.name), r.tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
  FROM read r JOIN dealt d USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, tokens, CAST(e AS INTEGER) AS epoch
FROM (SELECT *, unnest(range(1, whole + 1)) AS e FROM run)
UNION ALL
SELECT doc_id, domain, lang, source, tokens, whole + 1 FROM run WHERE rest > 0 AND until <= rest
"""
)


OP11 = """
WITH read AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_transform(
           regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'),
           lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM read)
  GROUP BY lang, term HAVING count(*) >= 10
), grouped AS (
  SELECT DISTINCT lang, source FROM read
), used AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM read)
  GROUP BY lang, source, term
), filled AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n
  FROM grouped g JOIN kept k USING (lang) LEFT JOIN used u USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2))
           // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS BIGINT) AS p
  FROM filled
), wholes AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2))
           // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term)
), pairs AS (
  SELECT g.lang, g.source, o.source AS item,
         coalesce((SELECT CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT)
                   FROM shares a JOIN shares b USING (lang, term)
                   WHERE a.lang = g.lang AND a.source = g.source AND b.source = o.source), 0) AS value
  FROM grouped g JOIN grouped o ON g.lang = o.lang AND g.source <> o.source
), own AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN wholes USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM own) WHERE rank <= 10
"""

OP13 = """
WITH read AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS lines,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM read
), cut AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parted AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
         array_to_string(lines[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1, "op3_warc": OP3, "op10_source_mixture": OP10,
        "op11_source_divergence": OP11, "op13_fill_in_middle": OP13,
    }
