"""Distance and nearest-center expressions for integer 2-D points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def squared_distance(x1: Column | str, y1: Column | str, x2: Column | str, y2: Column | str) -> Column:
    """Squared Euclidean distance in doubles (no root; cast first so nothing overflows)."""
    dx = as_col(x1).cast("double") - as_col(x2).cast("double")
    dy = as_col(y1).cast("double") - as_col(y2).cast("double")
    return dx * dx + dy * dy


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nearest_center(x: Column | str, y: Column | str, centers: Sequence[tuple[int, int]]) -> Column:
    """Index of the closest center; ties go to the lowest index.

    ``least`` over ``struct(distance, index)`` compares distance first and the
    index second, which is exactly a strict ``<`` scan from index 0. It stays a
    single codegen expression with the centers as literals.

    With column names the expression is handed to Spark as one SQL string, so
    building it costs one call into the JVM instead of several per center;
    Lloyd builds a new one every pass.
    """
    centers = [(int(cx), int(cy)) for cx, cy in centers]
    if not centers:
        raise ValueError("no centers")
    if len(centers) == 1:
        return F.lit(0)
    if isinstance(x, str) and isinstance(y, str):
        px, py = f"CAST({_quote(x)} AS DOUBLE)", f"CAST({_quote(y)} AS DOUBLE)"
        cands = ", ".join(
            f"named_struct('d', ({px} - {cx}D) * ({px} - {cx}D) + ({py} - {cy}D) * ({py} - {cy}D), 'i', {i})"
            for i, (cx, cy) in enumerate(centers))
        return F.expr(f"least({cands}).i")
    structs = [
        F.struct(squared_distance(x, y, F.lit(cx), F.lit(cy)).alias("d"), F.lit(i).alias("i"))
        for i, (cx, cy) in enumerate(centers)
    ]
    return F.least(*structs).getField("i")


def nearest_center_array(x: str, y: str, centers: Sequence[tuple[int, int]]) -> Column:
    """Index of the closest center, with the centers passed as one array literal.

    Same answer as ``nearest_center`` (``array_min`` compares (distance, index)
    structs field by field, so ties go to the lowest index). Spark keeps an
    array literal out of the generated Java source, so Lloyd passes with new
    centers reuse the compiled stage; ``nearest_center`` inlines every
    coordinate and is compiled again each pass (seconds for 45 centers). The
    price is an interpreted loop over the centers per row: the right trade on
    a histogram of distinct points, the wrong one on billions of raw points.
    """
    centers = [(int(cx), int(cy)) for cx, cy in centers]
    if not centers:
        raise ValueError("no centers")
    arr = "array(" + ", ".join(f"named_struct('x', {cx}D, 'y', {cy}D)" for cx, cy in centers) + ")"
    px, py = f"CAST({_quote(x)} AS DOUBLE)", f"CAST({_quote(y)} AS DOUBLE)"
    return F.expr(f"array_min(transform({arr}, (c, i) -> named_struct("
                  f"'d', ({px} - c.x) * ({px} - c.x) + ({py} - c.y) * ({py} - c.y), 'i', i))).i")
