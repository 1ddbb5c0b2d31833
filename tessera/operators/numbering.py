"""Dense numbers over a whole table or within groups of any size, with no window over an unbounded partition.

Rows are range-partitioned by the wanted order, sorted and written; a row's
place is its partition and its row in it (``monotonically_increasing_id``). Only
the partitions' row counts, one row each, reach the driver to become offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions._util import as_col
from tessera.session import materialize

# Fixed value: monotonically_increasing_id holds the partition above these bits.
_ROW_BITS = 33
_AT, _PART, _BASE, _START = "__at", "__part", "__base", "__start"


def _laid_out(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` in the wanted order, written, with each row's place and partition."""
    order = [as_col(c) for c in order]
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id())
    return materialize(laid, name).withColumn(_PART, F.shiftright(_AT, _ROW_BITS))


def number_rows(df: DataFrame, order: Sequence[Column | str], *, out: str = "n", start: int = 0,
                weight: str | None = None) -> DataFrame:
    """``df`` with a column ``out``: the rows' dense numbers in ``order``, from ``start``.

    With ``weight`` (a non-negative integer column) the number is the sum of the
    weights before the row instead, so that groups numbered by their sizes get
    the first number of their members. Rows equal in ``order`` come in any order.
    """
    laid = _laid_out(df, order, "numbered")
    size = F.sum(weight) if weight else F.count(F.lit(1))
    parts = sorted(tuple(r) for r in laid.groupBy(_PART).agg(size.cast("bigint"), F.min(_AT)).collect())
    before = [start, *accumulate((n for _, n, _ in parts), initial=start)][1:]
    base = df.sparkSession.createDataFrame(
        [(p, b, at) for (p, _, at), b in zip(parts, before, strict=False)], f"{_PART} bigint, {_BASE} bigint, {_START} bigint")
    numbered = laid.join(F.broadcast(base), _PART)  # one row a partition
    if weight:
        within = Window.partitionBy(_PART).orderBy(_AT)  # a partition is one task's share of the rows
        inside = F.sum(weight).over(within) - F.col(weight)
    else:
        inside = F.col(_AT) - F.col(_START)
    return numbered.withColumn(out, (F.col(_BASE) + inside).cast("bigint")).drop(_AT, _PART, _BASE, _START)


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *, out: str = "rank") -> DataFrame:
    """``df`` with a column ``out``: each row's dense number, from 0, among the rows with its ``keys``, in ``order``.

    A group that fills many partitions is numbered in each and shifted by what
    it has in the partitions before, so no task holds more than a partition's
    share of it. Null keys form a group.
    """
    keys = list(keys)
    laid = _laid_out(df, [*keys, *order], "ranked")
    key = F.struct(*keys)
    # Of the groups in a partition only the first can have begun before it.
    edges = sorted(laid.groupBy(_PART).agg(F.min_by(key, _AT).alias("first"), F.max_by(key, _AT).alias("last")).collect())
    goes_on = [b[_PART] for a, b in zip(edges[:-1], edges[1:], strict=True) if a["last"] == b["first"]]
    rank = F.row_number().over(Window.partitionBy(_PART, *keys).orderBy(_AT)) - 1
    ranked = laid.withColumn(out, rank.cast("bigint"))
    if goes_on:
        key_fields = [T.StructField(f"__k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
        same = reduce(and_, (F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
        first = {b[_PART]: tuple(b["first"]) for b in edges}
        # At most one group a partition goes on into the next.
        spanning = df.sparkSession.createDataFrame(list({first[p] for p in goes_on}), T.StructType(key_fields))
        counts = laid.join(F.broadcast(spanning), same, "left_semi").groupBy(_PART, key.alias("key")).agg(
            F.count(F.lit(1)).alias("c")).collect()
        shifts, seen = [], {}
        for r in sorted(counts, key=lambda r: r[_PART]):
            k = tuple(r["key"])
            if k in seen:
                shifts.append((r[_PART], *k, seen[k]))
            seen[k] = seen.get(k, 0) + r["c"]
        shift = df.sparkSession.createDataFrame(shifts, T.StructType(
            [T.StructField("__p", T.LongType()), *key_fields, T.StructField(_BASE, T.LongType())]))
        ranked = ranked.join(F.broadcast(shift), (F.col(_PART) == F.col("__p")) & same, "left").withColumn(
            out, F.col(out) + F.coalesce(_BASE, F.lit(0)))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], out)
