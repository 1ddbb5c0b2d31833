"""Exact top-k inner products by block-at-a-time pruning.

Vectors of integer components (the terms) are laid out in ranges of vec_id, cut
into blocks. A block keeps its forward index (the vectors themselves) and, per
term, the largest and smallest component. For a query q the sum over the terms
of max(q * largest, q * smallest) bounds every score in the block. Each query
visits the blocks of a range in descending order of that bound, scores them
through the forward index, and stops when the next bound falls below its k-th
score so far. Ranges are searched in parallel and their best k merged.

A query's first k-th score comes from the range that it lies in, while that is
laid out. The same bound, on the terms' extremes of a whole range, then decides
which ranges a group of queries has to see: only extremes meet every group, and
a range's vectors travel to the groups that hold a query whose bound reaches its
k-th score. Where vectors lie near others of similar ids few pairs of range and
group are left; where they don't, all are searched.

Tasks hold one group and one range, so memory does not grow with either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, partitions, stored

RANGE = 4096
BLOCK = 256
GROUP = 2048
#: Scores beyond a long count as the nearest one.
LIMIT = (1 << 63) - 1
#: Stands for the k-th score of a query that has seen fewer than k candidates.
NONE = -(1 << 63)
#: Ranges whose extremes travel in one row.
PACK = 256
RANGES = "no long, ids binary, matrix binary, width int, high binary, low binary, asking binary, seeds binary"


def _matrix(column: pa.ListArray, scale: float) -> np.ndarray:
    """floor(scale * x) of lists as rows, short ones filled up with zeros."""
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.floor(
        column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    return out


def _widen(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (a, b))


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matrices as they are if their products fit doubles exactly, else as Python integers; infinite components count as the largest double."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if top < 2.0 ** 53:
        return a, b
    largest = np.finfo(np.float64).max
    return tuple(np.array([[int(v) for v in r] for r in np.clip(x, -largest, largest).tolist()], dtype=object).reshape(x.shape) for x in (a, b))


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray, limit: int | None) -> np.ndarray:
    """Per query and row of extremes, the most that a score can be."""
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    if limit is not None and bound.dtype == object:  # what cannot pass the limit cannot beat it
        bound = np.clip(bound, -limit, limit)
    return bound


def _pack(m: np.ndarray) -> bytes:
    """Whole numbers in single precision where that is exact."""
    return m.astype("<f4" if np.abs(m).max(initial=0) < 2.0 ** 24 else "<f8").tobytes()


def _unpack(blob: bytes, rows: int, width: int) -> np.ndarray:
    single = len(blob) == rows * width * 4
    return np.frombuffer(blob, "<f4" if single else "<f8").reshape(rows, width).astype(np.float64)


def _places() -> int:
    """First number of this task's rows; numbers rise with the partition."""
    return TaskContext.get().partitionId() << 32


def search_range(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
                 block: int = BLOCK, limit: int | None = None, seeds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of each query's best k in one range, and the number of (query, block) pairs scored.

    Higher scores first, ties to smaller ids; a vector with the query's id is
    left out. Scores beyond ``limit`` count as it. ``seeds`` are scores that a
    query's k-th is known to reach; what lies below them may be left out.
    """
    queries, vectors = _exact(*_widen(queries, vectors))
    blocks = [slice(i, i + block) for i in range(0, len(vectors), block)]
    high = np.array([vectors[s].max(axis=0) for s in blocks]).reshape(len(blocks), -1)
    low = np.array([vectors[s].min(axis=0) for s in blocks]).reshape(len(blocks), -1)
    bound = _bounds(queries, high, low, limit)
    held = limit is not None and bound.dtype == object
    order = np.argsort(-bound, axis=1, kind="stable")
    none = -(1 << 200) if bound.dtype == object else -np.inf
    kth = np.full(len(queries), none, dtype=bound.dtype) if seeds is None else seeds.astype(bound.dtype)
    best_q, best_id, best_s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bound.dtype)
    scored = 0
    rows = np.arange(len(queries))
    for turn in range(len(blocks)):
        # A bound equal to the k-th score may still bring a smaller id.
        open_ = rows[bound[rows, order[rows, turn]] >= kth[rows]]
        rows = open_
        if not len(rows):
            break
        scored += len(rows)
        found = [(best_q, best_id, best_s)]
        at = order[rows, turn]
        for b in np.unique(at).tolist():
            qs = rows[at == b]
            score = queries[qs] @ vectors[blocks[b]].T
            score = np.clip(score, -limit, limit) if held else score
            own = ids[blocks[b]][None, :] == query_ids[qs][:, None]
            least = kth[qs]
            if score.shape[1] > k + 1 and bound.dtype != object:  # of a block no more than k and one's own can stay
                least = np.maximum(least, -np.partition(-score, k, axis=1)[:, k])
            q, c = np.nonzero((score >= least[:, None]) & ~own)
            found.append((qs[q], ids[blocks[b]][c], score[q, c]))
        q, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.lexsort((i, -s, q))
        q, i, s = q[by], i[by], s[by]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        best_q, best_id, best_s = q[keep], i[keep], s[keep]
        size = np.bincount(best_q, minlength=len(queries))
        full = np.flatnonzero(size >= k)
        kth[full] = best_s[np.cumsum(size)[full] - 1]
    return best_q, best_id, best_s, scored


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def lay_out(v: DataFrame, ranges: int, *, k: int, scale: float) -> DataFrame:
    """The ranges of ``v`` (id, v, q): forward index, extremes per term, and for the queries inside their place and k-th score."""

    def compute(batches):
        no = _places()
        for batch in batches:
            for i in range(0, batch.num_rows, RANGE):
                part = batch.slice(i, RANGE)
                ids, m = part.column("id").to_numpy(), _matrix(part.column("v"), scale)
                asking = np.flatnonzero(part.column("q").to_numpy(zero_copy_only=False))
                row, _, score, _ = search_range(m[asking], ids[asking], m, ids, k, limit=LIMIT)
                size = np.bincount(row, minlength=len(asking))
                seeds = [int(score[e - 1]) if n >= k else NONE for n, e in zip(size.tolist(), np.cumsum(size).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                     pa.array([_pack(m)], pa.binary()), pa.array([m.shape[1]], pa.int32()),
                     pa.array([m.max(axis=0).tobytes()], pa.binary()), pa.array([m.min(axis=0).tobytes()], pa.binary()),
                     pa.array([asking.astype("<i4").tobytes()], pa.binary()),
                     pa.array([np.array(seeds, "<i8").tobytes()], pa.binary())],
                    names=["no", "ids", "matrix", "width", "high", "low", "asking", "seeds"])
                no += 1

    return stored(v.repartitionByRange(ranges, "id", F.xxhash64("v")).sortWithinPartitions("id", "v").transform(
        in_tasks, compute, RANGES), "topk-ranges")


def query_groups(laid: DataFrame, groups: int) -> DataFrame:
    """(g, part, q_ids, q_matrix, q_width, q_seeds): at most ``GROUP`` queries of neighbouring ids a row, in ``groups`` parts."""

    def pick(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at, ids = np.frombuffer(r["asking"], "<i4"), np.frombuffer(r["ids"], "<i8")
                m = _unpack(r["matrix"], len(ids), r["width"])[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array([_pack(x) for x in m], pa.binary()),
                     pa.array(np.full(len(at), r["width"], np.int32)), pa.array(np.frombuffer(r["seeds"], "<i8"))],
                    names=["id", "row", "width", "seed"])

    def gather(batches):
        g = _places()
        for batch in batches:
            for i in range(0, batch.num_rows, GROUP):
                part = batch.slice(i, GROUP)
                rows, widths = part.column("row").to_pylist(), part.column("width").to_pylist()
                m = np.zeros((len(rows), max(widths)))
                for k, (blob, w) in enumerate(zip(rows, widths, strict=True)):
                    m[k, :w] = _unpack(blob, 1, w)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                     pa.array([part.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([_pack(m)], pa.binary()),
                     pa.array([m.shape[1]], pa.int32()), pa.array([part.column("seed").to_numpy().astype("<i8").tobytes()], pa.binary())],
                    names=["g", "part", "q_ids", "q_matrix", "q_width", "q_seeds"])
                g += 1

    rows = laid.filter(F.length("asking") > 0).select("ids", "matrix", "width", "asking", "seeds").transform(
        in_tasks, pick, "id long, row binary, width int, seed long")
    return stored(rows.repartitionByRange(groups, "id", F.xxhash64("row")).sortWithinPartitions("id", "row").transform(
        in_tasks, gather, "g long, part int, q_ids binary, q_matrix binary, q_width int, q_seeds binary"), "topk-queries")


def open_pairs(laid: DataFrame, asked: DataFrame, groups: int) -> DataFrame:
    """(no, g) of the ranges and groups where some query's bound over the range reaches its k-th score."""

    def pack(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, PACK):
                part = batch.slice(i, PACK)
                widths = part.column("width").to_pylist()
                high, low = np.zeros((2, len(widths), max(widths)))
                for k, w in enumerate(widths):
                    high[k, :w] = np.frombuffer(part.column("high")[k].as_py())
                    low[k, :w] = np.frombuffer(part.column("low")[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("no").to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([high.shape[1]], pa.int32()),
                     pa.array([high.tobytes()], pa.binary()), pa.array([low.tobytes()], pa.binary())],
                    names=["nos", "width", "high", "low"])

    def meet(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nos, seeds = np.frombuffer(r["nos"], "<i8"), np.frombuffer(r["q_seeds"], "<i8")
                q = _unpack(r["q_matrix"], len(seeds), r["q_width"])
                ends = np.concatenate([np.frombuffer(r[c]).reshape(len(nos), r["width"]) for c in ("high", "low")])
                q, ends = _exact(*_widen(q, ends))
                bound = _bounds(q, ends[: len(nos)], ends[len(nos):], LIMIT)
                near = nos[(bound >= seeds.astype(bound.dtype)[:, None]).any(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(np.full(len(near), r["g"]))], names=["no", "g"])

    packs = laid.select("no", "width", "high", "low").transform(in_tasks, pack, "nos binary, width int, high binary, low binary")
    packs = packs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return packs.join(asked.select("g", "part", "q_matrix", "q_width", "q_seeds"), "part").select(
        "nos", "width", "high", "low", "g", "q_matrix", "q_width", "q_seeds").transform(in_tasks, meet, "no long, g long")


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row where ``is_query`` holds.

    Components become floor(scale * x). Scores are integer inner products,
    ties go to the smaller id; a query with fewer than k candidates gets all.
    Rows without an id, vectors that are null or hold a null or non-finite
    component take no part. A vector shorter than another counts as filled up
    with zeros. Rows equal in id and vector count once; a candidate with the
    query's id is the query's own row and is left out. Rows of one id with
    different vectors are separate candidates, and as queries share one list.
    Scores beyond a long are held at its limits, and order goes by these.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q")).filter(F.col("id").isNotNull() & _usable(F.col("v")))
    v = v.groupBy("id", "v").agg(F.max("q").alias("q"))
    v = stored(v, "topk-vectors")
    n, n_queries = v.agg(F.count("*"), F.count_if("q")).first()
    ranges, groups = max(1, -(-n // RANGE)), max(1, -(-n_queries // GROUP))
    spread = max(1, min(ranges, partitions(spark) // groups))
    laid = lay_out(v, ranges, k=k, scale=scale)
    asked = query_groups(laid, groups)
    pairs = open_pairs(laid, asked, groups)

    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qid, ids = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["ids"], "<i8")
                q, m = _unpack(r["q_matrix"], len(qid), r["q_width"]), _unpack(r["matrix"], len(ids), r["width"])
                row, cid, score, _ = search_range(q, qid, m, ids, k, limit=LIMIT, seeds=np.frombuffer(r["q_seeds"], "<i8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[row]), pa.array(cid), pa.array([int(s) for s in score.tolist()], pa.int64())],
                    names=["query_id", "vec_id", "score"])

    # A pair's place is its group and a hash of the range, so few groups still make many tasks.
    shipped = pairs.join(laid.select("no", "ids", "matrix", "width"), "no").withColumn(
        "salt", F.expr(f"cast(pmod(xxhash64(no), {spread}) as int)"))
    salted = asked.drop("part").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    best = shipped.join(salted, ["g", "salt"]).select("ids", "matrix", "width", "q_ids", "q_matrix", "q_width", "q_seeds").transform(
        in_tasks, search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
