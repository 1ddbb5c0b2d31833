"""Sharding by minimax contiguous partition of atomic groups.

Rows of equal text are one atomic group. The groups, ordered by their smallest
doc_id (ties and null ids by the text's digest), are cut into contiguous shards
so that the largest shard is as small as any such cut allows. That capacity is
found by binary search: a capacity is feasible if filling the shards greedily,
each as far as it goes, uses no more of them than there are. The cuts are then
laid within that capacity, each shard taking an even part of what is left.

The ordered groups stay in a table. The driver sees sums over runs of
neighbouring groups (``_Runs``), at most one a partition to begin with. A greedy
fill over runs gives a lower and an upper bound of every shard's end; where
these leave a capacity undecided, the runs that hold an end are split into
``FANOUT`` smaller ones by one aggregate over them, down to single groups. So
the search is exact, and what it brings to the driver does not grow with the
number of rows or groups beyond one row a partition.

Everything is DataFrame functions; no key, group or shard passes through one
task (a hot group's rows are split by the join's skew handling and by ranges
that include the row number).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import as_row, partitions, stored

SHARDS = 16
#: Runs that one undecided run is split into.
FANOUT = 1024
#: Undecided runs split by one job.
AT_ONCE = 64
#: monotonically_increasing_id is the partition above these bits and the row in it below.
ROW_BITS = 33


class _Runs:
    """The ordered groups as runs: place of the first group, number of groups, bytes, largest group."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        part = F.shiftright("place", ROW_BITS)
        self.rows = sorted(tuple(r) for r in groups.groupBy(part.alias("part")).agg(
            F.min("place"), F.count("*"), F.sum("bytes"), F.max("bytes")).drop("part").collect())
        self._add_up()

    def _add_up(self) -> None:
        self.ends = [0, *accumulate(r[2] for r in self.rows)]
        self.total = self.ends[-1]

    def single(self, i: int) -> bool:
        return self.rows[i][1] == 1

    def split(self, which: set[int]) -> None:
        """Splits up to ``AT_ONCE`` of the runs by one aggregate over their groups."""
        some = sorted(which)[:AT_ONCE]
        cell, cond = F.lit(None).cast("long"), F.lit(False)
        for i in some:
            first, n = self.rows[i][:2]
            inside = F.col("place").between(first, first + n - 1)
            step = -(-n // FANOUT)
            cell = F.when(inside, first + F.expr(f"((place - {first}L) div {step}L) * {step}L")).otherwise(cell)
            cond = cond | inside
        found = self.groups.filter(cond).groupBy(cell.alias("cell")).agg(
            F.min("place"), F.count("*"), F.sum("bytes"), F.max("bytes")).drop("cell").collect()
        gone = set(some)
        self.rows = sorted([r for i, r in enumerate(self.rows) if i not in gone] + [tuple(r) for r in found])
        self._add_up()

    def last_end(self, at: int) -> tuple[int, int, int | None]:
        """Bounds of the last group end at or before ``at``, and the run that leaves them apart."""
        if at >= self.total:
            return self.total, self.total, None
        i = bisect_right(self.ends, at) - 1
        if self.single(i) or self.ends[i] == at:
            return self.ends[i], self.ends[i], None
        return max(self.ends[i], at - self.rows[i][3] + 1), at, i

    def first_end(self, at: int) -> tuple[int, int | None]:
        """The first group end at or after ``at`` (of the runs known), and the run that may hold an earlier one."""
        i = bisect_left(self.ends, max(0, at))
        if self.ends[i] == max(0, at) or self.single(i - 1):
            return self.ends[i], None
        return self.ends[i], i - 1

    def feasible(self, capacity: int, shards: int) -> tuple[bool | None, set[int]]:
        """Whether a greedy fill needs at most ``shards`` shards, or None and the runs to split."""
        low = high = 0
        undecided = set()
        for _ in range(shards):
            a, _, i = self.last_end(low + capacity)
            _, b, j = self.last_end(high + capacity)
            if i is not None or j is not None:
                left, right = (bisect_right(self.ends, x + capacity) - 1 for x in (low, high))
                undecided |= {k for k in range(left, min(right + 1, len(self.rows))) if not self.single(k)}
            low, high = a, b
        if low >= self.total:
            return True, set()
        if high < self.total:
            return False, set()
        return None, undecided

    def capacity(self, shards: int) -> int:
        """The smallest feasible capacity, by binary search."""
        largest = max(r[3] for r in self.rows)
        low = max(largest, -(-self.total // shards))
        high = min(self.total, low + largest)  # with it every full shard holds more than an even part
        while low < high:
            middle = (low + high) // 2
            ok, undecided = self.feasible(middle, shards)
            if ok is None:
                self.split(undecided)
            elif ok:
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """The ends of the shards but the last: even parts of what is left, none above ``capacity``."""
        while True:
            undecided = set()
            earliest = [self.total]  # an end before it would leave more than the later shards can take
            for _ in range(shards - 1):
                end, i = self.first_end(earliest[-1] - capacity)
                undecided |= {i} - {None}
                earliest.append(end)
            out, at = [], 0
            for k, least in enumerate(reversed(earliest[1:])):
                end, _, i = self.last_end(at + (self.total - at) // (shards - k))
                if i is not None:
                    end = self.ends[i]
                step, j = self.first_end(at + 1) if at < self.total else (at, None)
                undecided |= {i, j} - {None}
                at = max(end, least, step)
                out.append(at)
            if not undecided:
                return out
            self.split(undecided)

    def place(self, end: int) -> int | None:
        """The place of the first group after ``end``; None after the last."""
        i = bisect_left(self.ends, end)
        return self.rows[i][0] if i < len(self.rows) else None


def assign(docs: DataFrame, *, shards: int = SHARDS, keep: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs`` (doc_id, text).

    ``size`` is the text's UTF-8 bytes plus 1; a null text has none and goes
    with the empty ones (crc32 0). Rows of equal text are in one shard, whatever
    their ids; repeated rows are rows like others. Ties between groups go by the
    text's digest, null ids come last. ``slot`` numbers a shard's rows from 0 in
    the groups' order, then by doc_id. The law kept is ``bytes``, so
    ``grown_shard`` is null. A group larger than an even part makes a shard
    larger than one, and with fewer groups than shards some stay empty. An empty
    table gives no rows. Other columns are ignored or, with ``keep``, returned
    with the row as one struct ``doc``.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = partitions(docs.sparkSession)
    payload = [as_row(docs, "doc")] if keep else []
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key"),
        F.monotonically_increasing_id().alias("row"), *payload), "shard-rows")
    order = [F.col("first").asc_nulls_last(), F.col("key")]
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    groups = stored(groups.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "key", "bytes", F.monotonically_increasing_id().alias("place")), "shard-groups")
    runs = _Runs(groups)
    starts = []
    if runs.total:
        cuts = runs.cuts(runs.capacity(shards), shards)
        starts = [p for p in map(runs.place, cuts) if p is not None]
    shard = sum((F.when(F.col("place") >= p, 1).otherwise(0) for p in starts), F.lit(0))
    placed = rows.join(groups.select(F.col("key").alias("of"), "place"), F.expr("key = of")).withColumn("shard", shard.cast("int"))
    order = [F.col("place"), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = stored(placed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("key", "of", "row", "place").withColumn(
        "at", F.monotonically_increasing_id()), "shard-placed").withColumn("part", F.shiftright("at", ROW_BITS))
    before = Window.partitionBy("shard").orderBy("part")
    counts = placed.groupBy("shard", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    counts = counts.select("shard", "part", (F.sum("n").over(before) - F.col("n") - F.col("low")).alias("shift"))
    # One row a shard and partition at most.
    return placed.join(F.broadcast(counts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["doc"] if keep else []))


def write(docs: DataFrame, path: str, *, shards: int = SHARDS) -> None:
    """Writes the shards as Parquet folders ``shard=k`` of (slot, doc), ``doc`` being the whole row."""
    assign(docs, shards=shards, keep=True).select("shard", "slot", "doc").write.partitionBy("shard").parquet(path)
