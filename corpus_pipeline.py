"""A training corpus from ``documents``: five stages of ``returnscope.llm``.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet in the shared folder and
reads again as the next one's docs.  All stages but the last return the
columns of docs.

1. ``quality_classifier`` drops documents whose score is below 0.7.
2. ``jaccard_join`` keeps the row of the smallest doc_id of each component of texts
   that share 80 % of their five-word shingles or more.
3. ``substring_dedup`` removes the words of repeated 20-word windows from the
   texts; n_chars becomes the length of what is left.
4. ``decontamination`` drops documents that hold a benchmark item.
5. ``source_mixing`` adds n_tokens, domains and the rate that brings the
   label domains to equal token totals.

Stages 2 and 4 decide row by row, by a key of their own: rows that share a doc_id
with a copy or a contaminated text are judged by their own text, and rows without
doc_id pass both unchanged.  Texts without a word are linked with nothing and
stay.  Null texts stay null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnscope.llm import common, decontaminate, jaccard, mixing, quality, substring

#: The boosted trees and the hash-based joins have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.learn(docs, _table(spark, sf_dir, "labels")), threshold=0.7)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    order = [F.col("doc_id"), F.xxhash64("text"), F.rand(3)]  # equal rows spread by the last
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    key = common.free_name(docs, "_row_key")
    keyed = common.written(ranged.withColumn(key, F.monotonically_increasing_id()), "keyed")  # in order of doc_id
    found = jaccard.jaccard_components(keyed.filter("doc_id IS NOT NULL").select(F.col(key).alias("doc_id"), "text"), k=5, percent=80)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(key))
    return keyed.join(gone, key, "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    # keys of its own, so that columns of the input cannot clash with the operator's
    carried = docs.select("doc_id", "text", *(F.col(c).alias(f"_{i}") for i, c in enumerate(others)), F.col("text").isNull().alias("_null"))
    left = substring.dedup_substrings(carried, k=20, keep=(*(f"_{i}" for i in range(len(others))), "_null"), with_text=True)
    left = left.withColumn("text", F.when(~F.col("_null"), F.col("text")))
    restored = {c: F.col(f"_{i}") for i, c in enumerate(others)}
    if "n_chars" in restored:
        changed = F.col("n_removed") > 0
        restored["n_chars"] = F.when(changed, F.length("text")).otherwise(restored["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return left.select(*(restored.get(c, F.col(c)).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_to_targets(docs, _table(spark, sf_dir, "labels"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
