"""Load what parses and put the rest aside, in one scan.

A source's ``mark_*`` function gives every row its parsed columns, the raw text
and a reason, null for a row that parses. ``set_aside`` writes them once, good
and bad rows to their own folders, counts both on the way (``observe``) and
returns the two tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW, REASON, FILE = "raw", "reason", "file"
_GOOD = "good"


class TooManyBadRows(ValueError):
    """More rows were put aside than the caller allows; both tables stay written."""


@dataclass(frozen=True)
class Loaded:
    """``good``: the parsed rows. ``bad``: (raw, reason[, file]) of the others. Their numbers, counted while writing."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def set_aside(marked: DataFrame, path: str, *, max_bad: int | None = None) -> Loaded:
    """Writes ``marked`` (parsed columns, ``raw``, ``reason`` and perhaps ``file``) below ``path``, once.

    Good rows keep the parsed columns, bad rows the raw text, the reason and the
    file; what the other table has is null there and takes no room. Both are read
    from the written folders, so the source is scanned and parsed once however
    often they are used. With ``max_bad``, more bad rows than that are an error.
    """
    apart = [c for c in (RAW, REASON, FILE) if c in marked.columns]
    fields = [f for f in marked.schema.fields if f.name not in apart]
    ok = F.col(REASON).isNull()
    seen = Observation()
    both = marked.observe(seen, F.count_if(ok).alias("n_good"), F.count_if(~ok).alias("n_bad"))
    both = both.select(*[F.when(ok, F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
                       *[F.when(~ok, F.col(c)).alias(f"a{i}") for i, c in enumerate(apart)], ok.alias(_GOOD))
    both.write.partitionBy(_GOOD).parquet(path)
    written = marked.sparkSession.read.schema(T.StructType(
        [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)]
        + [T.StructField(f"a{i}", T.StringType()) for i in range(len(apart))] + [T.StructField(_GOOD, T.BooleanType())])).parquet(path)
    good = written.where(F.col(_GOOD)).select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)])
    bad = written.where(~F.col(_GOOD)).select(*[F.col(f"a{i}").alias(c) for i, c in enumerate(apart)])
    counts = seen.get
    if max_bad is not None and counts["n_bad"] > max_bad:
        raise TooManyBadRows(f"{counts['n_bad']} bad rows, {max_bad} allowed; they are in {path}")
    return Loaded(good, bad, counts["n_good"], counts["n_bad"])


def lines_with_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file): one row per line and the file it is from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))


def kept(df: DataFrame, names: Sequence[str]) -> list:
    """Of ``names`` the columns that ``df`` has."""
    return [F.col(n) for n in names if n in df.columns]
