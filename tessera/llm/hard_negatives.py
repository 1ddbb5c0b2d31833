"""Hard-negative mining with exact scores by the method of Four Russians.

Every anchor's vector is cut into groups of eight dimensions, and for each group
a table holds the sums of all 256 subsets of its eight components. A candidate
is held as bit planes: byte g of plane b packs bit b of its eight components of
group g, in two's complement. Looking the byte up in the anchor's table sums the
components whose bit is set; the lookups of a plane, added up and shifted by the
plane's weight (the sign plane's is negative), give the whole inner product.

Positives come first: each task scores its candidates of the anchor's label and
keeps the best few. With the positives' scores known, a second pass scores the
candidates of other labels and keeps, for each anchor and positive, the best few
in the positive's score window. So every pair is scored once. Candidates are
dealt evenly over tasks, whatever their labels, and never travel; anchors go to
the tasks in rounds of at most ``ROUND_BYTES``.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, partitions, stored
from tessera.llm.topk_search import _matrix, _usable

#: Vectors of a task and of a block in it; anchors scored side by side.
RANGE = 8192
BLOCK = 1024
SIDE = 256
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Bytes of anchors and thresholds broadcast at once.
ROUND_BYTES = 32 << 20
#: Scores beyond a long count as the nearest one.
LIMIT = (1 << 63) - 1
#: Products up to here are summed in 64 bits, beyond in Python integers.
PLAIN = float(1 << 62)


def _integers(m: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers if they fit, else as Python integers; infinite products count as the largest double."""
    if np.abs(m).max(initial=0) < PLAIN:
        return m.astype(np.int64)
    m = np.clip(m, -np.finfo(np.float64).max, np.finfo(np.float64).max)
    return np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape)


def _pad(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, subset, anchor]: sums of all subsets of each eight components of integer vectors (rows)."""
    n, d = anchors.shape
    columns = np.moveaxis(anchors.reshape(n, d // 8, 8), 0, 2)
    out = np.zeros((d // 8, 256, n), dtype=anchors.dtype)
    for bit in range(8):
        out[:, 1 << bit: 2 << bit] = out[:, : 1 << bit] + columns[:, bit: bit + 1]
    return out


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """[plane, group, row]: bytes of bit planes of integer vectors, the last plane holding the signs."""
    n, d = vectors.shape
    low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
    planes = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    bits = np.empty((planes, d // 8, n), dtype=np.uint8)
    for b in range(planes):
        plane = ((vectors >> b) & 1).astype(np.uint8).reshape(n, d // 8, 8)
        bits[b] = np.packbits(plane, axis=2, bitorder="little")[:, :, 0].T
    return bits


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[candidate, anchor]: inner products from the anchors' tables and the candidates' planes, saturated at a long."""
    total = np.zeros((planes.shape[2], tables.shape[2]), dtype=tables.dtype)
    for b in range(len(planes) - 1, -1, -1):
        total = -total if b == len(planes) - 2 else total  # the plane above it holds the signs
        total *= 2
        for g in range(len(tables)):
            total += np.take(tables[g], planes[b, g], axis=0)
    if len(planes) == 1:
        total = -total
    return total.astype(np.int64) if total.dtype != object else np.clip(total, -LIMIT, LIMIT).astype(np.int64)


def fit(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``anchors`` in the narrowest integers that hold every sum met in scoring ``vectors``."""
    bound = 4.0 * float(np.abs(vectors).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(1, vectors.shape[1])
    return anchors.astype(np.int32 if bound < 1 << 30 else np.int64 if bound < PLAIN else object)


def _keep(found: list, k: int) -> list[np.ndarray]:
    """The best k of each anchor of several (anchor, id, score): higher scores first, ties to smaller ids."""
    anchor, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((ids, -score, anchor))
    a = anchor[by]
    by = by[np.arange(len(a)) - np.searchsorted(a, a) < k]
    return [anchor[by], ids[by], score[by]]


class _Anchors:
    """One round of anchors by label: numbers, ids, labels, integer components and each positive's window of scores."""

    def __init__(self, rows: list, positives: int):
        rows = sorted(rows, key=lambda r: r["label"])
        self.rows = np.array([r["at"] for r in rows], dtype=np.int64)
        self.ids = np.array([r["id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        width = max(len(r["v"]) for r in rows) // 8
        self.vectors = _integers(np.frombuffer(b"".join(r["v"].ljust(8 * width, b"\0") for r in rows)).reshape(len(rows), width))
        known = [[x["positive_score"] for x in r["positives"] or []] if "positives" in r else [] for r in rows]
        known = [x + [None] * (positives - len(x)) for x in known]
        # 30 p <= 100 n <= 90 p in whole scores; an empty window where there is no such positive.
        self.low = np.array([[1 if x is None else -(-LOW * x // 100) for x in r] for r in known], dtype=np.int64)
        self.high = np.array([[0 if x is None else HIGH * x // 100 for x in r] for r in known], dtype=np.int64)

    def side(self, of: slice, width: int, vectors: np.ndarray) -> np.ndarray:
        """The tables of some anchors against ``vectors`` of ``width``."""
        return subset_sums(fit(_pad(self.vectors[of], width), vectors))


def _slices(first: int, last: int, size: int):
    return (slice(i, min(i + size, last)) for i in range(first, last, size))


def _candidates(batch: pa.RecordBatch, anchors: _Anchors, scale: float):
    """(ids, labels, integer components) of a batch by label, as wide as the anchors and a multiple of eight."""
    m = _matrix(batch.column("v"), scale)
    width = -(-max(m.shape[1], anchors.vectors.shape[1]) // 8) * 8
    ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy().astype(np.int64)
    by = np.argsort(labels, kind="stable")
    return ids[by], labels[by], _integers(_pad(m[by], width)), width


def find_positives(anchors: _Anchors, batches, k: int, scale: float):
    """(anchor place, id, score) of the best k candidates of each anchor's label."""
    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        ids, labels, vectors, width = _candidates(batch, anchors, scale)
        found = [held]
        for label in np.unique(anchors.labels).tolist():
            mine = np.searchsorted(anchors.labels, [label, label + 1])
            theirs = np.searchsorted(labels, [label, label + 1])
            planes = [(c, bit_planes(vectors[c])) for c in _slices(*theirs.tolist(), BLOCK)]
            for of in _slices(*mine.tolist(), SIDE) if planes else ():
                tables = anchors.side(of, width, vectors)
                for c, bits in planes:
                    s = np.where(ids[c, None] == anchors.ids[None, of], -LIMIT - 1, scores(tables, bits)).T
                    if s.shape[1] > k:
                        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k, None]
                        n, at = np.nonzero((s >= least) & (s > -LIMIT - 1))
                    else:
                        n, at = np.nonzero(s > -LIMIT - 1)
                    found.append([of.start + n, ids[c][at], s[n, at]])
        held = _keep(found, k)
    return held


def find_negatives(anchors: _Anchors, batches, k: int, scale: float):
    """(anchor place * positives + positive, id, score) of the best k candidates of other labels in each window."""
    positives = anchors.low.shape[1]
    low = anchors.low.copy()
    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        ids, labels, vectors, width = _candidates(batch, anchors, scale)
        planes = [(c, bit_planes(vectors[c])) for c in _slices(0, len(ids), BLOCK)]
        for of in _slices(0, len(anchors.ids), SIDE):
            tables = anchors.side(of, width, vectors)
            own = (held[0] >= of.start * positives) & (held[0] < of.stop * positives)
            rest, best = [x[~own] for x in held], [x[own] for x in held]
            for c, bits in planes:
                other = labels[c, None] != anchors.labels[None, of]
                other &= ids[c, None] != anchors.ids[None, of]
                s = np.where(other, scores(tables, bits), -LIMIT - 1).T
                found = [best]
                for p in range(positives):
                    inside = (s >= low[of, p, None]) & (s <= anchors.high[of, p, None]) & (s > -LIMIT - 1)
                    if s.shape[1] > k and np.count_nonzero(inside) > 2 * k * len(s):  # the block's k-th bounds what can stay
                        least = np.partition(np.where(inside, s, -LIMIT - 1), s.shape[1] - k, axis=1)[:, s.shape[1] - k, None]
                        inside &= s >= least
                    n, at = np.nonzero(inside)
                    found.append([(of.start + n) * positives + p, ids[c][at], s[n, at]])
                best = _keep(found, k)
                size = np.bincount(best[0], minlength=low.size)
                full = np.flatnonzero(size >= k)
                low.reshape(-1)[full] = best[2][np.cumsum(size)[full] - 1]
            held = [np.concatenate(x) for x in zip(rest, best, strict=True)]
    return held


def _rounds(anchors: DataFrame, width: int, positives: int):
    """Anchors in rounds of at most ``ROUND_BYTES`` (one anchor at least), as ranges [first, last) of ``at``."""
    each = max(1, ROUND_BYTES // (8 * width + 16 * positives + 64))
    part = F.shiftright("at", 33)  # of monotonically_increasing_id
    parts = sorted(tuple(r) for r in anchors.groupBy(part.alias("part")).agg(F.min("at"), F.count("*")).drop("part").collect())
    ends = [0, *accumulate(n for _, n in parts)]
    firsts = []
    for i, (at, n) in enumerate(parts):
        firsts += [at + j - ends[i] for j in range(-(-ends[i] // each) * each, ends[i] + n, each)]
    return list(zip(firsts, [*firsts, LIMIT][1:], strict=True))


def _scan(vectors: DataFrame, rows: list, positives: int, negatives: int, scale: float) -> DataFrame:
    """at, anchor_id, nth, id, score: what each task keeps of its candidates, positives first or, these known, negatives."""
    shared = vectors.sparkSession.sparkContext.broadcast(rows)

    def compute(batches):
        anchors = _Anchors(shared.value, positives)
        if negatives:
            place, ids, score = find_negatives(anchors, batches, negatives, scale)
            place, nth = place // positives, place % positives
        else:
            place, ids, score = find_positives(anchors, batches, positives, scale)
            nth = np.zeros(len(place), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors.rows[place]), pa.array(anchors.ids[place]), pa.array(nth.astype(np.int32)), pa.array(ids), pa.array(score)],
            names=["at", "anchor_id", "nth", "id", "score"])

    return vectors.select("id", "label", "v").transform(
        in_tasks, compute, "at long, anchor_id long, nth int, id long, score long")


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best k a key over all tasks; a key has at most k rows a task."""
    over = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, *, label: Column | str = "label", positives: int = 5, negatives: int = 10,
         scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive.

    Components become floor(scale * x), scores are integer inner products, and
    higher ones come first, ties to the smaller id. Positives are the anchor's
    best ``positives`` rows of its label; negatives the best ``negatives`` rows
    of other labels with 30 * positive_score <= 100 * negative_score <=
    90 * positive_score, so a positive with a negative score has none.

    Rows without an id or label, vectors that are null or hold a null or
    non-finite component take no part. A vector shorter than another counts as
    filled up with zeros. Rows equal in id, label and vector count once; rows of
    an anchor's id are its own and neither its positives nor its negatives; rows
    of one id that differ are separate candidates and separate anchors. Scores
    beyond a long are held at its limits, and order and windows go by these.
    Other columns are ignored; an empty table, or one without anchors, gives no
    rows.
    """
    spark = vectors.sparkSession
    of = F.col(label) if isinstance(label, str) else label
    v = vectors.select(F.col(id_col).cast("long").alias("id"), of.cast("long").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    v = v.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v")))
    v = v.groupBy("id", "label", "v").agg(F.max("anchor").alias("anchor"))
    v = stored(v, "negatives-vectors")
    n, width = v.agg(F.count("*"), F.max(F.size("v"))).first()
    v = stored(v.repartition(max(1, min(partitions(spark), -(-n // RANGE))), F.xxhash64("id", "v")), "negatives-dealt")

    def as_bytes(batches):
        for b in batches:
            blobs = [x.tobytes() for x in _matrix(b.column("v"), scale)]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("id"), b.column("label"), pa.array(blobs, pa.binary())],
                                             names=["at", "id", "label", "v"])

    anchors = stored(v.filter("anchor").select("id", "label", "v").withColumn("at", F.monotonically_increasing_id()).select(
        "at", "id", "label", "v").transform(in_tasks, as_bytes, "at long, id long, label long, v binary"), "negatives-anchors")
    out = None
    for first, last in _rounds(anchors, width or 0, positives):
        some = anchors.filter((F.col("at") >= first) & (F.col("at") < last))
        found = _top(_scan(v, some.collect(), positives, 0, scale), ["at"], positives).select(
            "at", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        found = stored(found, "negatives-positives")
        lists = found.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
        known = some.join(lists, "at").collect()
        if not known:
            continue
        best = _top(_scan(v, known, positives, negatives, scale), ["at", "nth"], negatives)
        pairs = found.select(F.col("at").alias("of"), F.expr("rank - 1").alias("of_nth"), "positive_id", "positive_score")
        done = stored(best.join(pairs, F.expr("at = of and nth = of_nth")).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")), "negatives-found")
        out = done if out is None else out.unionAll(done)
    return out if out is not None else spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
