"""Posts in a bucketed layout: the pairs join and the best score read it without an exchange.

Posts are written once as two tables, questions and answers, both bucketed by
the question's id into the same number of buckets and sorted by it. The shuffle
is paid when they are written; every later join on the question, or aggregate by
it, starts on co-located buckets. A question with a third of all answers fills
one bucket, so its bucket is one task there: for such data use the shuffled
``pair_parent_child``, whose join AQE splits, or ``best_child_score``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.pairs import ANSWER, QUESTION, _no_parent


@dataclass(frozen=True)
class PostTables:
    """Names of the catalog's tables (qid, tag) and (qid, aid, score)."""

    questions: str
    answers: str


def write_bucketed(posts: DataFrame, name: str, path: str, *, buckets: int, strict: bool = True) -> PostTables:
    """Writes ``posts`` (ptype, id, parent, score, tag) as tables ``<name>_questions`` and ``<name>_answers`` below ``path``.

    An answer without a parent id fails the job unless ``strict=False``, which
    leaves it out. Tables of these names are replaced.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    parent = F.col("parent")
    answers = posts.where(F.col("ptype") == ANSWER)
    answers = answers.where(_no_parent(parent, F.lit(True)).cast("boolean") if strict else parent.isNotNull())
    sides = {
        f"{name}_questions": posts.where(F.col("ptype") == QUESTION).select(F.col("id").alias("qid"), "tag"),
        f"{name}_answers": answers.select(parent.alias("qid"), F.col("id").alias("aid"), "score"),
    }
    for table, side in sides.items():
        # One file a bucket: the repartition deals rows to tasks as the buckets do.
        side.repartition(buckets, "qid").write.mode("overwrite").option("path", f"{path}/{table}").bucketBy(
            buckets, "qid").sortBy("qid").saveAsTable(table)
    return PostTables(*sides)


def bucketed_pairs(spark: SparkSession, tables: PostTables) -> DataFrame:
    """(qid, tag, aid, score): questions with their answers; no exchange between the scans and the join."""
    # A merge join: a broadcast would be one, and buckets come sorted.
    return spark.table(tables.questions).hint("merge").join(spark.table(tables.answers), "qid").select("qid", "tag", "aid", "score")


def bucketed_best_score(spark: SparkSession, tables: PostTables, *, floor: int | None = None) -> DataFrame:
    """(qid, tag, score): the best answer's score of every answered question; no exchange at all."""
    best = spark.table(tables.answers).groupBy("qid").agg(F.max("score").alias("score"))
    out = spark.table(tables.questions).hint("merge").join(best, "qid").select("qid", "tag", "score")
    return out if floor is None else out.withColumn("score", F.greatest(F.lit(floor), "score"))
