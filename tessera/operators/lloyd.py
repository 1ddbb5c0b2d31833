"""Exact integer Lloyd k-means on 2-D integer points.

Distances are *squared* Euclidean (no root) and the convergence threshold eta
is compared in those squared units. New centers are integer means truncated
toward zero; an empty cluster keeps its center.

Each pass is one distributed aggregation: points are first folded into a
weighted histogram of distinct (x, y) -- the sums and counts are the same
integers -- which is written once to the shared checkpoint folder, so the
passes read a small table and a lost executor never replays the source scan.
Only the k new centers come back to the driver per pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geometry import nearest_center, nearest_center_array
from tessera.session import materialize, path_exists

# Convergence threshold and iteration cap of the reference run.
KMEANS_ETA = 20.0
KMEANS_MAX_ITERATIONS = 45

Centers = list[tuple[int, int]]


def point_histogram(vectors: DataFrame, *, x: str = "x", y: str = "y") -> DataFrame:
    """(x, y, w): distinct points with their multiplicity (partial counts map-side)."""
    return vectors.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("w"))


def assign_nearest(points: DataFrame, centers: Sequence[tuple[int, int]], *, out_col: str = "cluster",
                   inline: bool = False) -> DataFrame:
    """Add the index of the nearest center (ties → lowest index).

    The centers travel as one array literal, so each Lloyd pass reuses the
    compiled stage, for any number of centers. ``inline=True`` writes them into
    the generated code instead: compiled anew each time, faster per row, and
    for few centers only.
    """
    centers = [(int(a), int(b)) for a, b in centers]
    expr = nearest_center if inline else nearest_center_array
    return points.withColumn(out_col, expr("x", "y", centers).cast("int"))


def centroid_sums(points: DataFrame, centers: Sequence[tuple[int, int]], *, weight: str | None = None) -> DataFrame:
    """(cluster, x, y, n) over non-empty clusters: integer means truncated toward zero.

    ``weight`` names the multiplicity column of a histogram; without it every
    row is one point, whatever other columns it has.
    """
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    assigned = assign_nearest(points, centers)
    return (assigned.groupBy("cluster")
            .agg(F.sum(F.col("x").cast("bigint") * w).alias("sx"),
                 F.sum(F.col("y").cast("bigint") * w).alias("sy"),
                 F.sum(w).alias("n"))
            .select("cluster",
                    F.expr("sx div n").cast("int").alias("x"),
                    F.expr("sy div n").cast("int").alias("y"),
                    "n"))


def lloyd_update(points: DataFrame, centers: Sequence[tuple[int, int]], *, weight: str | None = None) -> Centers:
    """One pass: new centers on the driver (k rows); empty clusters keep their center."""
    new = list(centers)
    for r in centroid_sums(points, centers, weight=weight).collect():
        new[r["cluster"]] = (r["x"], r["y"])
    return new


def total_movement(old: Sequence[tuple[int, int]], new: Sequence[tuple[int, int]]) -> float:
    """Sum of squared center moves."""
    if len(old) != len(new):
        raise ValueError(f"{len(old)} vs {len(new)} centers")
    return float(sum(float(a - c) ** 2 + float(b - d) ** 2 for (a, b), (c, d) in zip(old, new)))


def centers_frame(spark: SparkSession, centers: Sequence[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(centers)],
                                 "cluster int, x int, y int")


HISTORY_SCHEMA = ("iteration int, cluster int, old_x int, old_y int, new_x int, new_y int, "
                  "moved double, total_moved double")


def history_frame(spark: SparkSession, history: list[dict]) -> DataFrame:
    cols = [c.split()[0] for c in HISTORY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(h[c] for c in cols) for h in history], HISTORY_SCHEMA)


class FitState:
    """A fit on durable storage: its points, its seeds and settings, and every finished pass.

    ``<path>/points`` is the histogram, ``<path>/fit`` the settings and seeds,
    written after it, and ``<path>/passes/iteration=n`` the trace of pass n, one
    row a center. A pass counts when all its rows are there, so a driver lost at
    any moment costs the pass it was in.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/fit/_SUCCESS")

    def create(self, points: DataFrame, weight: str | None, centers: Centers, eta: float) -> None:
        w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
        points.select("x", "y", w.alias("w")).write.mode("overwrite").parquet(f"{self.path}/points")
        seeds = self.spark.createDataFrame([(i, x, y, float(eta)) for i, (x, y) in enumerate(centers)],
                                           "cluster int, x int, y int, eta double")
        seeds.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/fit")

    def points(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/points")

    def settings(self) -> tuple[Centers, float]:
        rows = sorted(tuple(r) for r in self.spark.read.parquet(f"{self.path}/fit").select("cluster", "x", "y", "eta").collect())
        return [(x, y) for _, x, y, _ in rows], rows[0][3]

    def history(self) -> list[dict]:
        """The trace of the finished passes: k rows a pass."""
        passes = f"{self.path}/passes"
        if not path_exists(self.spark, passes):
            return []
        k = len(self.settings()[0])
        rows = sorted((r.asDict() for r in self.spark.read.schema(HISTORY_SCHEMA).parquet(passes).collect()),
                      key=lambda h: (h["iteration"], h["cluster"]))
        out: list[dict] = []
        for n in range(1, len(rows) // k + 1):
            this = [h for h in rows if h["iteration"] == n]
            if len(this) != k:
                break
            out += this
        return out

    def add(self, passed: list[dict]) -> None:
        folder = f"{self.path}/passes/iteration={passed[0]['iteration']}"
        history_frame(self.spark, passed).drop("iteration").coalesce(1).write.mode("overwrite").parquet(folder)


def trace(iteration: int, old: Centers, new: Centers) -> list[dict]:
    """One dict per cluster of a pass: the center before and after, its squared move and the pass's total."""
    moved = total_movement(old, new)
    return [{"iteration": iteration, "cluster": i, "old_x": ox, "old_y": oy, "new_x": nx, "new_y": ny,
             "moved": float(ox - nx) ** 2 + float(oy - ny) ** 2, "total_moved": moved}
            for i, ((ox, oy), (nx, ny)) in enumerate(zip(old, new, strict=True))]


def run_passes(means: Centers, update: Callable[[Centers], Centers], *, eta: float, max_iter: int,
               history: list[dict], state: FitState | None = None) -> tuple[Centers, list[dict]]:
    """Lloyd passes from ``means`` on, after those in ``history``, until one moves less than ``eta`` or ``max_iter`` are done."""
    done = history[-1]["iteration"] if history else 0
    moved = history[-1]["total_moved"] if history else float("inf")
    for it in range(done + 1, max_iter + 1):
        if moved < eta:
            break
        new = update(means)
        passed = trace(it, means, new)
        if state:
            state.add(passed)
        history += passed
        means, moved = new, passed[0]["total_moved"]
    return means, history


def _checked(centers: Sequence[tuple[int, int]], max_iter: int) -> Centers:
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    means = [(int(a), int(b)) for a, b in centers]
    if not means:
        raise ValueError("no initial centers")
    return means


def fit_lloyd(vectors: DataFrame, centers: Sequence[tuple[int, int]], *, eta: float = KMEANS_ETA,
              max_iter: int = KMEANS_MAX_ITERATIONS, weight: str | None = None, fold: bool = True,
              cut_lineage: bool = True, state: str | None = None) -> tuple[Centers, list[dict]]:
    """Run Lloyd passes until the total squared move is below ``eta`` or ``max_iter`` passes.

    Returns the final centers (the means *after* the last pass) and a trace,
    one dict per pass and cluster. ``vectors`` are points (x, y) or, with
    ``weight`` naming the multiplicity column, a histogram already.
    ``fold=False`` iterates on the raw points instead of folding them into a
    histogram (same result, slower). The points are
    written to the shared folder first unless ``cut_lineage=False`` (the
    caller passes a table that is already written).

    With ``state``, a folder, the points, the seeds and every pass are kept
    there: after a lost driver ``resume_lloyd`` goes on behind the last finished
    pass. A folder that holds a fit already is an error.
    """
    means = _checked(centers, max_iter)
    if weight:
        pts = vectors.select("x", "y", weight)
    else:
        pts = vectors.select("x", "y")
        if fold:
            pts, weight = point_histogram(pts), "w"
    if state:
        kept = FitState(pts.sparkSession, state)
        if kept.exists():
            raise ValueError(f"{state} holds a fit already: resume_lloyd goes on with it")
        kept.create(pts, weight, means, eta)
        return resume_lloyd(pts.sparkSession, state, max_iter=max_iter)
    if cut_lineage:
        pts = materialize(pts, "lloyd-points")
    return run_passes(means, lambda now: lloyd_update(pts, now, weight=weight), eta=eta, max_iter=max_iter, history=[])


def resume_lloyd(spark: SparkSession, state: str, *, max_iter: int = KMEANS_MAX_ITERATIONS) -> tuple[Centers, list[dict]]:
    """Goes on with the fit in the folder ``state`` behind its last finished pass; centers and whole trace as ``fit_lloyd``'s.

    Needs nothing but the folder. ``max_iter`` counts the passes done before; a
    fit that has converged comes back as it is.
    """
    kept = FitState(spark, state)
    if not kept.exists():
        raise ValueError(f"{state} holds no fit")
    means, eta = kept.settings()
    history = kept.history()
    if history:
        means = [(h["new_x"], h["new_y"]) for h in history[-len(means):]]
    points = kept.points()
    return run_passes(_checked(means, max_iter), lambda now: lloyd_update(points, now, weight="w"),
                      eta=eta, max_iter=max_iter, history=history, state=kept)


def collect_centers(seeds: DataFrame, expected: int | None = None) -> Centers:
    """Seed rows (cluster, x, y) → ordered center list; checks the count."""
    seeds = seeds.select("cluster", "x", "y")
    if expected is not None:
        seeds = seeds.limit(expected + 1)
    rows = sorted(seeds.collect(), key=lambda r: r["cluster"])
    if expected is not None and len(rows) != expected:
        raise ValueError(f"expected {expected} seeds, got {len(rows)}: some stratum has too few points")
    return [(r["x"], r["y"]) for r in rows]
