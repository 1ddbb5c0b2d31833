"""Describe clusters: dominant tag, its share, size and exact median score."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.lloyd import assign_nearest, point_histogram
from tessera.operators.quantiles import exact_median
from tessera.operators.vectors import LANG_SPREAD, LANGS

# Fixed value: line layout of the printed cluster report.
REPORT_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
REPORT_HEADER = ("Resulting clusters:",
                 "  Score  Dominant language (%percent)  Questions",
                 "================================================")


def summarize_clusters(vectors: DataFrame, centers: Sequence[tuple[int, int]],
                       tags: Sequence[str] = LANGS, *, spread: int = LANG_SPREAD,
                       weight: str | None = None) -> DataFrame:
    """(cluster, label, pct, size, median) for each non-empty cluster, by median then cluster.

    label: tag of the commonest x (ties → lowest x); pct: integer share of that
    tag in percent (truncated, as a double); median: exact, the truncated mean
    of the two middle scores when the size is even.

    Points are first folded into a weighted histogram (``weight`` names the
    multiplicity column of one that is folded already), so every aggregate
    below runs on distinct (cluster, x, y) with partial aggregation; the
    median is an exact radix selection on the weighted scores, whose state
    per task stays bounded however large one cluster is.
    """
    hist = vectors.select("x", "y", F.col(weight).alias("w")) if weight else point_histogram(vectors)
    assigned = assign_nearest(hist, centers)
    by_x = (assigned.groupBy("cluster", "x").agg(F.sum("w").alias("n"))
            .groupBy("cluster")
            .agg(F.max_by("x", F.struct(F.col("n"), -F.col("x"))).alias("top_x"),
                 F.max("n").alias("top_n")))
    stats = exact_median(assigned, "cluster", "y", "w", broadcast_targets=True)
    tag_arr = F.array(*[F.lit(t) for t in tags])
    # Both sides have one row per non-empty cluster (at most k).
    return (stats.join(F.broadcast(by_x), "cluster")
            .select("cluster",
                    F.element_at(tag_arr, (F.col("top_x") / F.lit(spread)).cast("int") + 1).alias("label"),
                    F.expr("top_n * 100 div size").cast("double").alias("pct"),
                    "size", "median")
            .orderBy("median", "cluster"))


def cluster_report(summary: DataFrame) -> DataFrame:
    """(cluster, line): one formatted report line per cluster, in summary order."""
    return summary.select(
        "cluster", "median",
        F.format_string(REPORT_FORMAT, F.col("median"), F.col("label"), F.col("pct"), F.col("size")).alias("line"),
    ).orderBy("median", "cluster").drop("median")


def print_report(summary: DataFrame, out: TextIO = sys.stdout) -> None:
    """Print the header and one line per cluster (at most k rows reach the driver)."""
    lines = [r["line"] for r in cluster_report(summary).select("line").collect()]
    print("\n".join([*REPORT_HEADER, *lines]), file=out)
