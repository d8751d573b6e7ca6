"""Queries of the training-data operators and the DuckDB SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from returnscope.llm import decontaminate, hnsw, jaccard, language, mixing, prefix_trie, quality, repair, substring, template, tokens, toxicity, warc
from returnscope.llm.conversation_sql import OP11_SQL, OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record, read back and merged into one capture index."""
    index = warc.placed(warc.archive_pages(table(spark, sf_dir, "pages")))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "place")


def op2_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return template.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, units or names."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, *language.learn(docs))


def op5_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), top=20, every=20)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per document that bring the domains of the labels to equal token totals."""
    return mixing.mix_to_targets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated 20-word windows."""
    return substring.dedup_substrings(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have Jaccard similarity 0.9 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by its cheapest edits."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_warc_index": op1_warc_index,
        "op2_template_extraction": op2_template_extraction,
        "op3_decontamination": op3_decontamination,
        "op4_language_id": op4_language_id,
        "op5_hnsw_search": op5_hnsw_search,
        "op6_source_mixing": op6_source_mixing,
        "op7_token_counts": op7_token_counts,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_structure_repair": op11_structure_repair,
        "op12_toxicity": op12_toxicity,
        "op13_prefix_trie": op13_prefix_trie,
    }


WORD_SPLIT = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Keys of http and https URLs in ASCII, with a host; place is the rank in the order of all capture histories.
OP1_SQL = """
WITH p AS (
    SELECT page_id, COALESCE(html, '') AS html, octet_length(encode(COALESCE(html, ''))) AS size,
           lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS scheme,
           lower(regexp_extract(url, '^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
           regexp_extract(url, '^[^/?#]*//[^/?#]*:([0-9]+)(?:[/?#]|$)', 1) AS port,
           regexp_extract(url, '^[^/?#]*//[^/?#]*([^?#]*)', 1) AS path,
           regexp_extract(url, '^[^?#]*(\\?[^#]+)', 1) AS query,
           TIMESTAMP '2024-01-01' + to_seconds((COALESCE(page_id, 0) % 1000000000 + 1000000000) % 1000000000) AS captured, url
    FROM pages
),
f AS (
    SELECT *, CASE WHEN size >= 100 THEN MIN(page_id) OVER (PARTITION BY html) ELSE page_id END AS first,
           CASE WHEN COALESCE(url, '') = '' THEN 'urn:page:' || page_id
                ELSE array_to_string(list_reverse(string_split(host, '.')), ',')
                     || CASE WHEN port IN ('', CASE scheme WHEN 'http' THEN '80' WHEN 'https' THEN '443' END) THEN '' ELSE ':' || port END
                     || ')' || CASE WHEN path = '' THEN '/' ELSE lower(path) END || lower(query) END AS url_key,
           strftime(captured, '%Y%m%d%H%M%S') AS timestamp
    FROM p
)
SELECT page_id, size AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, url_key, timestamp,
       row_number() OVER (ORDER BY url_key, timestamp, page_id NULLS FIRST) AS place
FROM f"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, {WORD_SPLIT.format(text="COALESCE(text, '')")} AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
spans AS (
    SELECT doc_id, i, string_agg(word, ' ') OVER w AS span, COUNT(*) OVER w AS n FROM words
    WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
repeats AS (
    SELECT doc_id, i, 1 AS again FROM spans WHERE n = 20 QUALIFY row_number() OVER (PARTITION BY span ORDER BY doc_id, i) > 1
),
marked AS (
    SELECT doc_id, i, word, MAX(COALESCE(again, 0)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM words LEFT JOIN repeats USING (doc_id, i)
)
SELECT doc_id, COUNT(word) AS n_words, COALESCE(SUM(gone), 0)::BIGINT AS n_removed,
       sha256(COALESCE(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
FROM d LEFT JOIN marked USING (doc_id) GROUP BY doc_id"""

OP10_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {WORD_SPLIT.format(text="translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents
),
words AS (SELECT doc_id, len(ws) AS size, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
spans AS (
    SELECT doc_id, size, string_agg(word, ' ') OVER w AS shingle, COUNT(*) OVER w AS n, i FROM words
    WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, shingle FROM spans WHERE n = 3 OR (i = 1 AND size < 3)),
sizes AS MATERIALIZED (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS n_both FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 90 * (p.n + q.n - n_both)
),
reach(x, y) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT x AS doc_id, COALESCE(n, 0) AS n_shingles, MIN(y) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = x GROUP BY x, n"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_index": OP1_SQL, "op9_substring_dedup": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op11_structure_repair": OP11_SQL, "op13_prefix_trie": OP13_SQL}
