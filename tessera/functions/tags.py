"""Tag → position in a fixed tag list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def tag_index(tag: Column | str, tags: Sequence[str]) -> Column:
    """0-based position of the first exact match, null when absent or null.

    ``array_position`` answers 0 for "absent", so it is turned into null before
    shifting to 0-based; otherwise an unknown tag would silently become -1.
    """
    arr = F.array(*[F.lit(t) for t in tags])
    pos = F.array_position(arr, as_col(tag))
    return (F.nullif(pos, F.lit(0)) - F.lit(1)).cast("int")
