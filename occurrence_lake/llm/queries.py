"""One query per operator over its whole table, with production parameters,
and the SQL that DuckDB can run for it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurrence_lake.llm import (bpe_stream, decontaminate, hard_negatives, html_extract, license_scan, quality, rule_cascade, simhash, spelling,
                                 syncmer, token_count, url_filter, warc)
from occurrence_lake.llm.common import table


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file: below ``OCCLAKE_TOKENIZERS``, else of the
    installed package."""
    if base := os.environ.get("OCCLAKE_TOKENIZERS"):
        return os.path.join(base, name)
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed rules of the contract: (text, action).
BASE_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: The method's own patterns, for urls that no base rule fits.
SPAM_PATTERNS = ["||spam-farm.", "||casino-win.", "||ads-track.", "||cheap-pills.", "||free-bets."]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.domain_rule(t, a) for t, a in BASE_RULES] + [url_filter.Rule(p, p, "block", 1) for p in SPAM_PATTERNS]
    out = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
    return out.select("page_id", "host", "path", F.when(F.col("tier") == 0, F.col("rule")).alias("rule"), "verdict",
                      F.when(F.col("tier") == 1, F.col("rule")).alias("pattern"))


OP1_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
split AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
rules(rule, action) AS (VALUES {", ".join(f"('{t}', '{a}')" for t, a in BASE_RULES)}),
fits AS (
  SELECT s.*, r.rule, r.action FROM split s LEFT JOIN rules r
  ON (s.host = split_part(r.rule, '/', 1) OR ends_with(s.host, '.' || split_part(r.rule, '/', 1)))
  AND starts_with(s.path, substr(r.rule, strpos(r.rule, '/')))),
best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS n FROM fits),
patterns(pattern) AS (VALUES {", ".join(f"('{p}')" for p in SPAM_PATTERNS)}),
spam AS (
  SELECT s.page_id, arg_max(p.pattern, length(p.pattern)) AS pattern FROM split s JOIN patterns p
  ON starts_with(s.host, substr(p.pattern, 3)) OR contains(s.host, '.' || substr(p.pattern, 3)) GROUP BY s.page_id)
SELECT b.page_id, b.host, b.path, b.rule, coalesce(b.action, CASE WHEN s.pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN b.rule IS NULL THEN s.pattern END AS pattern
FROM best b LEFT JOIN spam s USING (page_id) WHERE n = 1
"""


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, radius=3)


def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmer.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql_words(column: str) -> str:
    """Words of the contract in DuckDB."""
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split_regex({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
i AS (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(13, len(w)) AS n,
         unnest(list_transform(range(0, len(w) - least(13, len(w)) + 1), lambda s: array_to_string(w[s + 1:s + least(13, len(w))], ' '))) AS win
  FROM i WHERE len(w) > 0 AND item_id IS NOT NULL),
lengths AS (SELECT DISTINCT n FROM iw),
starts AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lengths WHERE len(w) >= n),
dw AS (SELECT doc_id, n, s, array_to_string(w[s + 1:s + n], ' ') AS win FROM starts),
occ AS (SELECT DISTINCT doc_id, item, s, n FROM dw JOIN iw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_archive_path(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    read = warc.read_records(warc.reconstruct(spark, path))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


#: Fixed phrases and labels of the contract.
BASE_PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
LEAST_SHARE = 0.6


def license_templates() -> list[license_scan.Template]:
    return [license_scan.phrase(label, words) for label, words in BASE_PHRASES] + license_scan.TEMPLATES


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_templates(), least_share=LEAST_SHARE)


OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words("text")} AS w FROM documents),
t(base, label, words, key, off) AS (VALUES {", ".join(
    f"({t.base}, '{t.label}', {t.words.split()}, {t.key.split()}, {t.key_offset})" for t in license_templates())}),
starts AS (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d),
near AS (SELECT starts.*, t.* FROM starts JOIN t ON starts.w[p + 1] = t.key[1]),
found AS (
  SELECT doc_id, base, label, p,
         len(list_filter(range(0, len(words)), lambda j: p - off + j >= 0 AND w[p - off + j + 1] = words[j + 1])) / len(words) AS share
  FROM near WHERE w[p + 1:p + len(key)] = key),
kept AS (SELECT * FROM found WHERE share >= {LEAST_SHARE}),
made AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(p) FILTER (base) AS first_word, max(p) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN made USING (doc_id)
"""


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = rule_cascade.judged(table(spark, sf_dir, "documents").select("doc_id", "text"), facts=facts)
    fact = lambda name: F.col(f"judged.{name}")
    failed = [rule.rejects(fact) for rule in rule_cascade.BASE_RULES]
    return judged.select("doc_id", *[fact(name).alias(name) for name in facts], (failed[0] | failed[1]).alias("base_failed"),
                         fact("rejected_by").isNull().alias("kept"))


_SQL_SPACE = "[\\x20\\x09-\\x0D]"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{_SQL_SPACE}+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
starts AS (SELECT doc_id, w, unnest(range(0, len(w) - 7)) AS s FROM d WHERE len(w) >= 8),
windows AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 8], ' ') AS win FROM starts),
again AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM again WHERE n > 1) GROUP BY doc_id),
facts AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]'))) AS n_letter_words,
         len(regexp_extract_all(text, '(?m)^[ \\t]*[-*•]')) AS n_bullet_lines, len(regexp_extract_all(text, '(?m)(\\.\\.\\.|…)[ \\t]*$')) AS n_open_lines
  FROM d LEFT JOIN repeated r USING (doc_id)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_dup_lines > 4 * n_lines
            OR 10 * n_letter_words < 6 * n_words OR 10 * n_bullet_lines > 9 * n_lines OR 10 * n_open_lines > 3 * n_lines) AS kept
FROM base
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), least_letters=7, least_count=2, change=spelling.drop_one_letter)
    return spelling.variants(words, ratio=10)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_syncmer_fingerprints": op3_syncmer_fingerprints,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_html_extraction": op6_html_extraction,
    "op7_warc_archive": op7_warc_archive,
    "op8_bpe_stream": op8_bpe_stream,
    "op9_license_scan": op9_license_scan,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_quality_rules": op11_quality_rules,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {"op1_url_filter": OP1_SQL, "op5_decontamination": OP5_SQL, "op9_license_scan": OP9_SQL, "op11_quality_rules": OP11_SQL, "op12_hard_negatives": OP12_SQL}
