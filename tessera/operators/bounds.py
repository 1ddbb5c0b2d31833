"""Exact Lloyd passes that compute a fraction of the distances, for many centers.

The points are cut once into cells of about as many centers each, by quantiles
of the seeds' x and, within these strips, of their y; a cell knows the box of its
points. For each pass the driver lists, per cell, the centers that can be nearest
or second nearest to any point of the box: those whose least distance to the box
is no more than the second smallest of all greatest distances.

Between passes every point keeps its cluster and a lower bound of its distance to
any other center. A point whose new distance to its own center is below that
bound, less what the other centers moved, or below half the way from its center
to the next one, stays without another distance. Only the others are compared
with their cell's candidates. Bounds carry a margin for rounding and decide only
strict cases, so clusters, ties and centers are those of the full comparison.

The points and their state are kept in blocks, a row each: an Arrow batch of
points with every column as one binary value, beside the batch's boxes or sums.
So a pass moves a few values a block, not a few a point, between Spark and numpy,
and the sums are read without the points. What a pass needs of the centers and
cells is broadcast. A point with a null coordinate belongs to center 0 without a
distance, as in the full comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.lloyd import (
    KMEANS_ETA,
    KMEANS_MAX_ITERATIONS,
    Centers,
    FitState,
    _checked,
    point_histogram,
    run_passes,
)
from tessera.session import in_tasks, materialize

# Relative margin for what square roots and sums of bounds may round.
MARGIN = 1e-9
# Candidates of all cells together that are broadcast (4 bytes each); cells are merged until they fit.
MAX_CANDIDATES = 2_000_000
# A block's columns: null coordinates are NaN, the bounds are rounded down.
_POINTS = {"x": "<f8", "y": "<f8", "w": "<i8", "cell": "<i4"}
_STATE = _POINTS | {"cluster": "<i4", "lower": "<f4"}
_BOXES = "boxes array<struct<cell int, x0 double, x1 double, y0 double, y1 double>>"
_SUMS = "sums array<struct<cluster int, x bigint, y bigint, n bigint, points bigint, cost bigint, searched bigint>>"


def _cuts(values: np.ndarray, parts: int) -> list[int]:
    """Up to ``parts`` - 1 distinct cuts of sorted values into runs of about the same size."""
    at = [int(values[len(values) * i // parts]) for i in range(1, parts)]
    return sorted({v for v in at if v > values[0]})


def _block(columns: dict[str, np.ndarray], dtypes: dict[str, str], name: str, summary: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row: the columns as binary values and ``summary`` as a list of structs."""
    values = {n: pa.array([np.ascontiguousarray(columns[n], dtype=d).tobytes()], pa.binary()) for n, d in dtypes.items()}
    rows = pa.StructArray.from_arrays([pa.array(v) for v in summary.values()], [*summary])
    return pa.RecordBatch.from_pydict(values | {name: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)})


def _of_blocks(batches, dtypes: dict[str, str]):
    """The columns of each block."""
    for b in batches:
        for i in range(b.num_rows):
            yield {n: np.frombuffer(b.column(n)[i].as_buffer(), dtype=d) for n, d in dtypes.items()}


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each value begins."""
    return np.flatnonzero(np.diff(sorted_values, prepend=sorted_values[:1] - 1))


def with_cells(points: DataFrame, centers: Centers, strips: int) -> DataFrame:
    """Blocks of ``points`` with their cell, by quantiles of the centers, and the boxes of these points by cell."""
    x_cuts = _cuts(np.sort(np.array([c[0] for c in centers])), strips)
    y_cuts = []
    edges = [-np.inf, *x_cuts, np.inf]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        ys = np.sort(np.array([y for x, y in centers if low <= x < high]))
        y_cuts.append(_cuts(ys, strips) if len(ys) else [])

    def place(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (b.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in ("x", "y"))
            strip = np.searchsorted(x_cuts, x, side="right")
            cell = strip * strips
            for s in np.unique(strip):
                at = strip == s
                cell[at] += np.searchsorted(y_cuts[s], y[at], side="right")
            order = np.argsort(np.where(np.isnan(x) | np.isnan(y), -1, cell), kind="stable")
            order = order[np.count_nonzero(np.isnan(x) | np.isnan(y)):]  # only whole points are in boxes
            first = _firsts(cell[order])
            of = lambda f, v: f.reduceat(v[order], first) if len(first) else np.empty(0)
            boxes = {"cell": cell[order][first].astype(np.int32), "x0": of(np.minimum, x), "x1": of(np.maximum, x),
                     "y0": of(np.minimum, y), "y1": of(np.maximum, y)}
            yield _block({"x": x, "y": y, "w": b.column("w").to_numpy(zero_copy_only=False), "cell": cell}, _POINTS, "boxes", boxes)

    return in_tasks(points.select("x", "y", "w"), place, ", ".join([*(f"{n} binary" for n in _POINTS), _BOXES]))


def _box_distances(boxes: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each center to each box (x0, x1, y0, y1)."""
    near, far = 0.0, 0.0
    for axis in (0, 1):
        low, high, c = boxes[:, 2 * axis, None], boxes[:, 2 * axis + 1, None], centers[None, :, axis]
        near = near + np.maximum(0, np.maximum(low - c, c - high)) ** 2
        far = far + np.maximum(np.abs(c - low), np.abs(c - high)) ** 2
    return near, far


def cell_candidates(boxes: np.ndarray, centers: Centers) -> list[np.ndarray]:
    """Per box the centers that can be nearest or second nearest to a point in it."""
    c = np.array(centers, dtype=np.float64)
    out = []
    for i in range(0, len(boxes), 256):
        near, far = _box_distances(boxes[i: i + 256], c)
        second = np.partition(far, min(1, len(c) - 1), axis=1)[:, min(1, len(c) - 1)]
        out += [np.flatnonzero(row) for row in near <= second[:, None] * (1 + MARGIN)]
    return out


class Cells:
    """The cells' boxes; of merged cells the common one."""

    def __init__(self, blocks: DataFrame):
        rows = blocks.select(F.inline("boxes")).groupBy("cell").agg(
            F.min("x0"), F.max("x1"), F.min("y0"), F.max("y1")).collect()  # at most strips ** 2
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.boxes = np.array([r[1:] for r in rows], dtype=np.float64).reshape(-1, 4)

    def lists(self, centers: Centers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a pass each cell's place and number of candidates, by cell, and the candidates: ascending within a list."""
        boxes, of = self.boxes, np.arange(len(self.ids))
        found = cell_candidates(boxes, centers)
        while sum(len(found[b]) for b in range(len(boxes))) > MAX_CANDIDATES and len(boxes) > 1:
            of = of // 2  # neighbours share a box and one list
            boxes = np.array([[a[:, 0].min(), a[:, 1].max(), a[:, 2].min(), a[:, 3].max()]
                              for a in (self.boxes[of == b] for b in range(of[-1] + 1))])
            found = cell_candidates(boxes, centers)
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        start, size = np.zeros((2, self.ids.max(initial=-1) + 1), dtype=np.int64)
        start[self.ids], size[self.ids] = (np.cumsum(sizes) - sizes)[of], sizes[of]
        return start, size, np.concatenate([*found, []]).astype(np.int32)


def _moves(old: Centers, centers: Centers) -> tuple[np.ndarray, np.ndarray]:
    """Per center half the distance to the next one, and how far any other center moved."""
    c = np.array(centers, dtype=np.float64)
    gap = np.full(len(c), np.inf)
    for i in range(0, len(c), 256):
        d = ((c[i: i + 256, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        gap[i: i + 256] = np.sqrt(d.min(axis=1)) / 2
    moved = np.sqrt(((c - np.array(old, dtype=np.float64)) ** 2).sum(axis=1))
    first = int(np.argmax(moved))
    drop = np.full(len(c), moved[first])
    drop[first] = np.delete(moved, first).max(initial=0.0)
    return gap, drop


def _nearest(x: np.ndarray, y: np.ndarray, start: np.ndarray, size: np.ndarray, candidates: np.ndarray,
             centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each point's candidates the nearest (ties: the first), and the squared distance to the second nearest.

    One candidate of every point at a time; the points with most candidates come
    first, so those that have another one are the first ones.
    """
    order = np.argsort(-size, kind="stable")
    x, y, start, falling = x[order], y[order], start[order], -size[order]
    nearest, least, second = np.full(len(x), -1, dtype=np.int32), np.full(len(x), np.inf), np.full(len(x), np.inf)
    for j in range(int(size.max(initial=0))):
        n = np.searchsorted(falling, -j)
        c = candidates[start[:n] + j]
        d = (x[:n] - centers[c, 0]) ** 2 + (y[:n] - centers[c, 1]) ** 2
        closer = d < least[:n]
        second[:n] = np.where(closer, least[:n], np.minimum(second[:n], d))
        least[:n], nearest[:n] = np.where(closer, d, least[:n]), np.where(closer, c, nearest[:n])
    back = np.empty(len(x), dtype=np.int64)
    back[order] = np.arange(len(x))
    return nearest[back], second[back]


def _block_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, cluster: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
    """Per cluster the sums over a block's points, null coordinates left out."""
    order = np.argsort(cluster, kind="stable")
    first = _firsts(cluster[order])
    if max(float((np.abs(np.nan_to_num(v)) * w).sum()) for v in (x, y)) >= 2.0**62:
        raise OverflowError("the sums of coordinates times weights exceed a long")
    per = {"x": np.nan_to_num(x).astype(np.int64) * w, "y": np.nan_to_num(y).astype(np.int64) * w, "n": w,
           "points": np.ones(len(w), dtype=np.int64), "cost": cost, "searched": (cost > 1).astype(np.int64)}
    return {"cluster": cluster[order][first].astype(np.int32)} | {n: np.add.reduceat(v[order], first) for n, v in per.items()}


def bounded_pass(blocks: DataFrame, cells: Cells, old: Centers | None, centers: Centers) -> DataFrame:
    """Blocks of the points with their clusters by ``centers``, from their state by ``old``, and the sums by cluster.

    Without ``old`` every point is compared with its cell's candidates. A
    point's cost is the number of distances computed for it.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(
        (cells.lists(centers), np.array(centers, dtype=np.float64), _moves(old, centers) if old else None))
    known = _STATE if old else _POINTS

    def compare(batches):
        (starts, sizes, candidates), c, moves = shared.value
        for b in _of_blocks(batches, known):
            x, y, cell = b["x"], b["y"], b["cell"]
            stay = np.isnan(x) | np.isnan(y)
            cost = np.zeros(len(x), dtype=np.int64)
            if moves:
                gap, drop = moves
                cluster, lower = b["cluster"].copy(), b["lower"].astype(np.float64)
                own = np.sqrt((x - c[cluster, 0]) ** 2 + (y - c[cluster, 1]) ** 2) * (1 + MARGIN)
                lower = lower * (1 - MARGIN) - drop[cluster] * (1 + MARGIN)
                cost[~stay] = 1
                stay |= own < np.maximum(lower, gap[cluster] * (1 - MARGIN))
            else:
                cluster, lower = np.zeros(len(x), dtype=np.int32), np.full(len(x), -1.0)
            at = np.flatnonzero(~stay)
            size = sizes[cell[at]]
            cluster[at], second = _nearest(x[at], y[at], starts[cell[at]], size, candidates, c)
            lower[at] = np.sqrt(second) * (1 - MARGIN)
            cost[at] += size
            state = b | {"cluster": cluster, "lower": np.nextafter(lower.astype(np.float32), np.float32(-np.inf))}
            yield _block(state, _STATE, "sums", _block_sums(x, y, b["w"], cluster, cost))

    return in_tasks(blocks.select(*known), compare, ", ".join([*(f"{n} binary" for n in _STATE), _SUMS]))


def _sums(blocks: DataFrame):
    """Per cluster the integer mean, and what the pass cost."""
    return blocks.select(F.inline("sums")).groupBy("cluster").agg(
        F.expr("cast(sum(x) div sum(n) as int)").alias("x"), F.expr("cast(sum(y) div sum(n) as int)").alias("y"), F.sum("n").alias("n"),
        F.sum("points").alias("points"), F.sum("cost").alias("cost"), F.sum("searched").alias("searched"))


class _Bounded:
    """The passes' update: keeps the points' state in the shared folder and the work done."""

    def __init__(self, points: DataFrame, centers: Centers, strips: int):
        counted = points.select("x", "y", F.col("w").cast("bigint").alias("w"))
        self.points = materialize(with_cells(counted, centers, strips), "bounded-points")
        self.cells = Cells(self.points)
        self.last: Centers | None = None
        self.work: list[dict] = []

    def update(self, means: Centers) -> Centers:
        self.points = materialize(bounded_pass(self.points, self.cells, self.last, means), "bounded-pass")
        self.last, new = means, list(means)
        rows = _sums(self.points).collect()  # one row a cluster
        for r in rows:
            new[r["cluster"]] = (r["x"], r["y"])
        points = sum(r["points"] for r in rows)
        self.work.append({"points": points, "searched": sum(r["searched"] for r in rows),
                          "distances": sum(r["cost"] for r in rows), "full": points * len(means)})
        return new


def fit_lloyd_bounded(vectors: DataFrame, centers: Sequence[tuple[int, int]], *, eta: float = KMEANS_ETA,
                      max_iter: int = KMEANS_MAX_ITERATIONS, weight: str | None = None,
                      state: str | None = None) -> tuple[Centers, list[dict], list[dict]]:
    """Centers and trace of ``fit_lloyd``, and the work of each pass run: points, searched, distances, full (= points x centers).

    For hundreds of centers and more; with few, ``fit_lloyd`` writes nothing
    between passes and is faster. ``state`` keeps the fit as ``fit_lloyd`` does,
    and a folder that holds one is gone on with.
    """
    spark = vectors.sparkSession
    means, history, kept = _checked(centers, max_iter), [], None
    points = vectors.select("x", "y", F.col(weight).alias("w")) if weight else point_histogram(vectors)
    if state:
        kept = FitState(spark, state)
        if not kept.exists():
            kept.create(points, "w", means, eta)
        points, (means, eta), history = kept.points(), kept.settings(), kept.history()
        if history:
            means = [(h["new_x"], h["new_y"]) for h in history[-len(means):]]
    # As many cells as centers.
    run = _Bounded(points, means, max(1, round(len(means) ** 0.5)))
    means, history = run_passes(means, run.update, eta=eta, max_iter=max_iter, history=history, state=kept)
    return means, history, run.work
