"""Exact grouped median of an integer column with bounded per-task state.

``percentile`` keeps one map of every distinct value per group, so a group
holding a third of the rows with many distinct values would sit in one task.
Here the median is found by radix selection instead: the value's bits are
read 16 at a time from the top. At each level the rows (only those whose
higher bits match the bucket chosen so far) are counted per 16-bit digit,
a running sum over at most 65,536 digits per group finds the digit that holds
each middle rank, and the next level refines only that bucket. Every shuffle
carries per-digit counts (pre-aggregated map-side), every window partition
has at most 65,536 rows, and the rank targets are two rows per group.

Semantics: odd size → the middle value; even size → the mean of the two
middle values truncated toward zero. Null values are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGIT_BITS = 16

_WIDTH = {T.ByteType: 32, T.ShortType: 32, T.IntegerType: 32, T.LongType: 64}


def _width(df: DataFrame, value: str) -> int:
    dtype = df.schema[value].dataType
    for cls, width in _WIDTH.items():
        if isinstance(dtype, cls):
            return width
    raise TypeError(f"exact_median needs an integer column; {value!r} is {dtype.simpleString()}")


def _pick(counts: DataFrame, part: list[str], digit: str) -> DataFrame:
    """Running sums per partition in digit order; keep the digit whose range holds rank ``r``."""
    w = Window.partitionBy(*part).orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.withColumn("_cum", F.sum("_w").over(w))
    return cum.where((F.col("_cum") - F.col("_w") <= F.col("_r")) & (F.col("_r") < F.col("_cum")))


def exact_median(df: DataFrame, group: str, value: str, weight: str | None = None, *,
                 median_col: str = "median", size_col: str = "size",
                 broadcast_targets: bool = False) -> DataFrame:
    """(group, size, median) per group with at least one non-null value.

    ``weight`` is an optional non-negative integer frequency per row (a
    histogram); size is the total weight. The median has the value's type
    widened to bigint before the final truncated mean, then cast back.
    ``broadcast_targets=True`` broadcasts the rank targets, two rows a group,
    so the rows are never shuffled to meet them; pass it where the number of
    groups is known to be small (k clusters). Else the planner and AQE decide.
    """
    width = _width(df, value)
    levels = width // DIGIT_BITS
    v = F.col(value).cast("bigint")
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    src = df.where(F.col(value).isNotNull()).select(F.col(group).alias("_g"), v.alias("_v"), w.alias("_w"))

    def digit(level: int):
        return F.shiftright(F.col("_v"), width - DIGIT_BITS * (level + 1))

    # Level 0: counts per top digit; the group size comes from the same window.
    top = src.groupBy("_g", digit(0).alias("_d")).agg(F.sum("_w").alias("_w"))
    total = F.sum("_w").over(Window.partitionBy("_g"))
    with_n = top.withColumn("_n", total)
    ranks = F.array(
        F.struct(F.lit(0).alias("which"), F.expr("(_n - 1) div 2").alias("r")),
        F.struct(F.lit(1).alias("which"), F.expr("_n div 2").alias("r")),
    )
    targets = with_n.select("_g", "_d", "_w", "_n", F.explode(ranks).alias("_t")).select(
        "_g", "_d", "_w", "_n", F.col("_t.which").alias("_which"), F.col("_t.r").alias("_r"))
    chosen = _pick(targets, ["_g", "_which"], "_d").select(
        "_g", "_which", "_n", F.col("_d").alias("_prefix"),
        (F.col("_r") - (F.col("_cum") - F.col("_w"))).alias("_r"))

    # Lower levels: only rows inside the chosen bucket, counted per next digit.
    # The digit is the value's top (level + 1) * 16 bits: inside one bucket it
    # takes at most 65,536 values, in the same order as the value.
    for level in range(1, levels):
        parent = F.shiftright(F.col("_v"), width - DIGIT_BITS * level)
        bucket = chosen.select(F.col("_g").alias("_cg"), "_which", "_n", "_prefix", "_r")
        if broadcast_targets:
            bucket = F.broadcast(bucket)
        inside = src.join(bucket, (F.col("_g") == F.col("_cg")) & (parent == F.col("_prefix")))
        counts = (inside.groupBy("_g", "_which", "_n", "_r", digit(level).alias("_d"))
                  .agg(F.sum("_w").alias("_w")))
        chosen = _pick(counts, ["_g", "_which"], "_d").select(
            "_g", "_which", "_n", F.col("_d").alias("_prefix"),
            (F.col("_r") - (F.col("_cum") - F.col("_w"))).alias("_r"))

    # After the last level the digit is the whole value (shift 0). The two
    # middle values are added in decimal so two large bigints cannot overflow.
    out_type = df.schema[value].dataType
    return chosen.groupBy("_g").agg(
        F.first("_n").alias(size_col),
        F.expr("sum(cast(_prefix AS decimal(20, 0))) div 2").cast(out_type).alias(median_col),
    ).withColumnRenamed("_g", group)
