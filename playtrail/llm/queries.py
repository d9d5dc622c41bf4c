"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtrail.llm.decontamination import find_overlaps
from playtrail.llm.html_text import extract_main_text
from playtrail.llm.multiset_hash import document_fingerprints
from playtrail.llm.packing import pack_documents
from playtrail.llm.pii import find_pii
from playtrail.llm.prefix_trie import conversation_trie
from playtrail.llm.quality import quality_scores
from playtrail.llm.resampling import resample
from playtrail.llm.search import B, DIGITS, K1, TOP_K, search_top_k
from playtrail.llm.secrets import find_secrets
from playtrail.llm.sharding import shard_documents
from playtrail.llm.simhash import simhash_groups
from playtrail.llm.store import table
from playtrail.llm.token_file import encode_documents, token_file_digest


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_file_digest(spark, path)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    asked = docs.where("doc_id % 100 = 0").selectExpr("doc_id AS query_id", "text")
    return search_top_k(docs, asked)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_best_fit_packing,
            op2_jump_sharding,
            op3_decontamination,
            op4_secret_scan,
            op5_quality,
            op6_pii,
            op7_token_file,
            op8_html_text,
            op9_search,
            op10_simhash,
            op11_prefix_trie,
            op12_multiset_hash,
            op13_resampling,
        )
    }


_SEARCH_SQL = f"""
WITH words AS (
  SELECT doc_id, regexp_replace(lower(word), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g') AS term
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents)
),
counted AS (
  SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS tf FROM words WHERE term <> '' GROUP BY ALL
),
lengths AS (
  SELECT d.doc_id, coalesce(sum(tf), 0) AS dl
  FROM documents AS d LEFT JOIN counted AS c ON d.doc_id = c.doc_id GROUP BY d.doc_id
),
corpus AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(dl) / count(*) AS mean_dl FROM lengths),
frequencies AS (
  SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf
  FROM counted, corpus GROUP BY term, n
),
scored AS (
  SELECT q.doc_id AS query_id, c.doc_id,
    round(sum(q.tf * idf * c.tf * {K1 + 1}
      / (c.tf + {K1} * (1 - {B} + {B} * dl / mean_dl))), {DIGITS}) AS score
  FROM counted AS q JOIN counted AS c ON q.term = c.term
  JOIN frequencies AS f ON f.term = c.term JOIN lengths AS l ON l.doc_id = c.doc_id, corpus
  WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, c.doc_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER)
    AS rank
  FROM scored WHERE score > 0
)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP_K}"""


def oracle_sql() -> dict[str, str]:
    return {"op9_search": _SEARCH_SQL}
