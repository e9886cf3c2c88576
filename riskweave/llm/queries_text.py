"""Queries whose rows depend on one document each (and on a learned model at most)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from riskweave.llm import compression_quality, fingerprints, language_id, license_scan, pseudonyms, quality, secret_scan, sentence_pieces, token_counts
from riskweave.llm.registry import documents, query


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query("op2_imatch_fingerprints")
def op2_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


WORD = r"[^\x20\x09-\x0D]+"


def _gram_sql(n: int, first: bool) -> str:
    """Words of each document that lie in an n-word window found earlier, or also later (``first``)."""
    window = ", ".join(["word", *(f"lead(word, {k}) OVER w" for k in range(1, n))])
    name = f"{n}_first" if first else f"{n}"
    again = "count(*) OVER (PARTITION BY doc_id, gram)" if first else "row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos)"
    return f"""
g{name} AS (SELECT doc_id, pos, CASE WHEN lead(pos, {n - 1}) OVER w IS NOT NULL THEN [{window}] END AS gram
         FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
t{name} AS (SELECT doc_id, pos, gram IS NOT NULL AND {again} > 1 AS twice FROM g{name}),
m{name} AS (SELECT doc_id, pos, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS marked FROM t{name}),
c{name} AS (SELECT doc_id, count(*) FILTER (WHERE marked) AS marked_words, sum(length(word)) FILTER (WHERE marked) AS marked_chars
         FROM m{name} JOIN words USING (doc_id, pos) GROUP BY doc_id)"""


def quality_sql(limits: quality.Limits, body: str, source: str = "documents") -> str:
    rejected = " OR ".join(
        [f"100 * line_chars > {limits.line_chars} * word_chars", *(f"100 * dup_chars_{n} > {most} * word_chars" for n, most in limits.gram_chars.items())]
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM {source}),
lists AS (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS ws FROM d),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM lists),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM d)),
again AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS seen FROM lines WHERE regexp_matches(line, '{WORD}')),
dup AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS line_chars FROM again WHERE seen GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY doc_id),
{",".join([_gram_sql(3, True), *(_gram_sql(n, False) for n in limits.gram_chars)])},
measured AS (
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c3_first.marked_words, 0)::BIGINT AS n_repeat_words,
       coalesce(line_chars, 0)::BIGINT AS line_chars,
       {", ".join(f"coalesce(c{n}.marked_chars, 0)::BIGINT AS dup_chars_{n}" for n in limits.gram_chars)}
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN c3_first USING (doc_id) {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in limits.gram_chars)}),
judged AS (
SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.repeat_words} * n_words AS base_failed, {rejected} AS rejected FROM measured)
{body}"""


@query("op3_repetition_quality", quality_sql(quality.Limits(), "SELECT * EXCLUDE (rejected), NOT (base_failed OR rejected) AS kept FROM judged"))
def op3_repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    base = F.sha2(F.col("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base, "spans", "n_key", "n_jwt")


#: A demonstration key; a real run passes its own.
KEY = b"riskweave demonstration key"


@query("op10_feistel_pseudonyms")
def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.replace(documents(spark, sf_dir), KEY)


def license_sql() -> str:
    def canonical(text: str) -> str:
        lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        words = f"trim(regexp_replace(regexp_replace({lowered}, '{license_scan.COPYRIGHT_LINE}', '', 'g'), '{license_scan.SEPARATOR}', ' ', 'g'), ' ')"
        listed = ", ".join(f"'{a}': '{b}'" for a, b in license_scan.SPELLINGS.items())
        return f"array_to_string(list_transform(string_split({words}, ' '), lambda w: coalesce(MAP {{{listed}}}[w], w)), ' ')"

    whole = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in license_scan.WHOLE)
    quoted = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in license_scan.KNOWN)
    return f"""
WITH texts(license, text) AS (VALUES {quoted}),
whole_texts(license, digest) AS (VALUES {whole}),
known AS (SELECT digest, string_agg(DISTINCT license, ' / ' ORDER BY license) AS license
          FROM (SELECT license, sha256({canonical("text")}) AS digest FROM texts UNION ALL SELECT license, digest FROM whole_texts) GROUP BY digest),
bare AS (SELECT *, CASE WHEN regexp_matches(text, '{license_scan.STATEMENT_LINE}') THEN regexp_replace(text, '{license_scan.STATEMENT_LINE}', '', 'g') END AS bare FROM documents),
wholes AS (SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS text_digest, CASE WHEN bare_form <> '' THEN sha256(bare_form) END AS bare_digest
           FROM (SELECT doc_id, {canonical("coalesce(text, '')")} AS form, {canonical("bare")} AS bare_form FROM bare)),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
forms AS (SELECT doc_id, n, {canonical("line")} AS form FROM lines),
hits AS (SELECT doc_id, count(*) AS n_notices, string_agg(n || ':' || license, ',' ORDER BY n) AS notices
         FROM forms JOIN known ON sha256(form) = digest WHERE form <> '' GROUP BY doc_id)
SELECT w.doc_id, text_digest, coalesce(k.license, b.license) AS license, coalesce(n_notices, 0)::BIGINT AS n_notices, coalesce(notices, '') AS notices
FROM wholes w LEFT JOIN known k ON w.text_digest = k.digest LEFT JOIN known b ON w.bare_digest = b.digest LEFT JOIN hits USING (doc_id)"""


@query("op5_license_digests", license_sql())
def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


@query("op4_unigram_pieces")
def op4_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_language_forward")
def op8_language_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_compression_quality")
def op11_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
