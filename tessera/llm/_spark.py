"""Spark-side helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import in_tasks, scratch_path

#: Spark's setting that deletes an execution's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared scratch folder and read back.

    Cuts lineage on storage that every executor sees, so a lost executor costs
    its running tasks only. The shuffle files of the write are deleted when it
    ends; nothing reads them again.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.select("*").write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def as_row(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that helper columns beside it can have any name."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of the connected components of ``edges`` (a, b: long), root the smallest node.

    Alternating star contraction: each round points neighbours at the smallest
    node they know (large star), then nodes at the smallest of their smaller
    neighbours (small star). Rows never outnumber the edges, the minimum per
    node is a partial aggregate, and each round is a table in the shared
    folder. Ends when a round changes nothing, which takes of the order of the
    square of the nodes' logarithm in rounds at most.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        # The rebalance puts an exchange of its own under the join, so AQE can split a hot node.
        least = e.groupBy("a").agg(F.min("b").alias("m")).hint("rebalance")
        m = F.least("a", "m")
        if large:
            out = e.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), m.alias("b"))
        else:
            out = e.join(least, "a").select(F.col("b").alias("a"), m.alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    both = edges.filter("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    now = stored(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        two_way = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        wide = star(two_way, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        now = stored(star(wide, False), name)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        mark = seen
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
