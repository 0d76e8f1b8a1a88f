"""The registered queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytally.llm import bpe, conversations, token_files, warc
from paytally.llm.best_positions import search
from paytally.llm.common import table
from paytally.llm.html_text import main_text
from paytally.llm.language import languages_of
from paytally.llm.packing import pack_documents
from paytally.llm.permutation_index import nearest
from paytally.llm.quality import RULES, STOP_WORDS, quality
from paytally.llm.simhash import near_duplicates
from paytally.llm.toxicity import toxicity
from paytally.llm.wu_manber import contamination
from paytally.session import scratch_path


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, path, public_tokenizers.PATTERN).drop("text")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_files.write(docs, scratch_path(spark, "tokens"), path, end_id=1)
    return token_files.digests(files)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, end_id=0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read(paths).drop("url")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages_of(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most=2, seed=42)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items, length=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_permutation_index": op1_permutation_index,
        "op2_bpe": op2_bpe,
        "op3_html_text": op3_html_text,
        "op4_token_files": op4_token_files,
        "op5_packing": op5_packing,
        "op6_quality_rules": op6_quality_rules,
        "op7_warc": op7_warc,
        "op8_toxicity": op8_toxicity,
        "op9_language": op9_language,
        "op10_simhash": op10_simhash,
        "op11_conversations": op11_conversations,
        "op12_best_positions": op12_best_positions,
        "op13_wu_manber": op13_wu_manber,
    }


def _rule_sql(rule) -> str:
    bounds = []
    if rule.low is not None:
        bounds.append(f"100 * {rule.part} < {rule.low} * greatest({rule.whole}, 1)")
    if rule.high is not None:
        bounds.append(f"100 * {rule.part} > {rule.high} * greatest({rule.whole}, 1)")
    only = ""
    if rule.only:
        own, of_all, share = rule.only
        only = f" AND 100 * {own} >= {share} * {of_all}"
    return f"(n_words >= {rule.least_words} AND ({' OR '.join(bounds)}){only})"


def _quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS k
  FROM w, unnest(range(1, len(words) - 6)) AS t(i)
),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n_repeat_words
  FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM repeated)
  GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(words) AS n_words, 1 AS one,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT)
           AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[a-zA-Z]', '', 'g')) AS BIGINT)
           AS n_ascii_letters,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•‣●]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_cut_lines,
         len(list_distinct(list_filter(list_transform(words, lambda x: lower(x)),
                                       lambda x: x IN ({stops})))) AS n_stop_words
  FROM w LEFT JOIN covered USING (doc_id)
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(map(_rule_sql, RULES))}) AS kept
FROM judged"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
),
t AS (SELECT count(*) AS nd, sum(len(words))::HUGEINT AS nw FROM d WHERE len(words) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, t GROUP BY term, nd
),
m AS (SELECT row, doc_id, CAST(50 + (50 * len(words) * nd) // nw AS BIGINT) AS m FROM d, t),
scored AS (
  SELECT item_id, doc_id, row,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (row) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50"""

CONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
q AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
lengths AS (SELECT DISTINCT least(10, len(words)) AS k FROM q WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS passage
  FROM (SELECT *, least(10, len(words)) AS k FROM q WHERE len(words) > 0),
       unnest(range(1, len(words) - k + 2)) AS t(i)
),
places AS (
  SELECT row, i, k, array_to_string(words[i:i + k - 1], ' ') AS passage
  FROM d, lengths, unnest(range(1, len(words) - k + 2)) AS t(i)
),
hits AS (SELECT row, i, k, item FROM places JOIN windows USING (k, passage)),
hit AS (
  SELECT row, count(DISTINCT j) AS n FROM hits, unnest(range(i, i + k)) AS t(j) GROUP BY row
),
found AS (
  SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(found.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN found USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_quality_rules": _quality_sql(),
        "op7_warc": WARC_SQL,
        "op12_best_positions": RANKED_SQL,
        "op13_wu_manber": CONTAMINATION_SQL,
    }
