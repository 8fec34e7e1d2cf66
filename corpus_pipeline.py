"""A corpus pipeline of the operators in ``tallyloom.llm``; each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from tallyloom.llm.common import free_prefix, kept_small
from tallyloom.plans.storage import materialize
from tallyloom.sources.tables import table

#: A document stays if its probability of good quality is at least this.
GOOD = 0.3
#: SQL cannot express the classifier, the retrieval and the packing.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier, fitted on the labelled ones of them, accepts."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    aside = free_prefix("__score", docs.columns)
    scored = quality.score_quality(docs.withColumnRenamed("score", aside), model)
    kept = scored.where(scored["score"] >= GOOD).drop("score")
    return kept.withColumnRenamed(aside, "score").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id. Rows with a null id stay."""
    groups = jaccard_join.near_duplicates(docs)
    dropped, _ = kept_small(groups.where("doc_id <> component_id").select("doc_id").distinct(), 16, "near-copies")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    files = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return packing.pack(docs, *files, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
