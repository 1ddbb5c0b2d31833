"""The corpus pipeline: documents in, token-id files out.

``STAGES`` are (name, function) in order; each function takes (spark, docs,
sf_dir), works on all rows of ``docs`` and returns a DataFrame. All but the last
return the columns of documents. ``run`` applies them to ``documents``, each
stage's result being written as Parquet and read again by the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, mixing, ngram_join, quality, token_ids
from tessera.llm._spark import stored
from tessera.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps (probability of a good grade 0.5 or more)."""
    # Other columns go under names that the classifier's own cannot clash with.
    other = [c for c in docs.columns if c not in ("doc_id", "text")]
    plain = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"other_{i}") for i, c in enumerate(other)))
    kept = quality.classify(plain, _table(spark, sf_dir, "labels")).filter("keep")
    named = {c: F.col(f"other_{i}").alias(c) for i, c in enumerate(other)}
    return kept.select(*(named.get(c, c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.remove_documents(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, as documents of the words taken."""
    return mixing.apply(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the documents; returns each document's place, length and checksum, read back from them."""
    path = scratch_path(spark, "pipeline-token-ids")
    token_ids.write(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_ids.digests(spark, path)


STAGES = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The classifier is trained here, which SQL cannot express; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
