"""Header-driven wide CSV: the first column is a string, every other column a double."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.aside import FILE, RAW, REASON, Loaded, set_aside


def schema_from_header(names: Sequence[str]) -> T.StructType:
    """First name → non-null string, the rest → non-null double, in order.

    File sources reset ``nullable`` to true on read, so ``read_wide_csv``
    checks the not-null rule on the data instead of trusting the schema.
    """
    names = list(names)
    if not names:
        raise ValueError("empty header")
    if len(set(names)) != len(names):
        raise ValueError("duplicate column names in header")
    return T.StructType([T.StructField(names[0], T.StringType(), False)]
                        + [T.StructField(n, T.DoubleType(), False) for n in names[1:]])


def header_names(spark: SparkSession, path: str | list[str], *, sep: str = ",") -> list[str]:
    """Column names from the first line (a one-partition job, no full scan); trailing empty names are dropped."""
    return _drop_empty_tail(_first_line(spark, path).split(sep))


def _first_line(spark: SparkSession, path: str | list[str]) -> str:
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first["value"]


def _drop_empty_tail(fields: list[str]) -> list[str]:
    while fields and fields[-1] == "":
        fields.pop()
    return fields


# A line is read whole, as the one column of a CSV with a separator that no line has (one that has it fails).
_NO_SEPARATOR = "\u0001\u0002\u0001"


def _data_lines(spark: SparkSession, path: str | list[str], header: str, check_header: bool) -> DataFrame:
    """(value, file): the lines of every file but its first, which is its header.

    Spark's CSV reader leaves the header out by its place, so a line further
    down that equals it is data. ``check_header``: a file with another header
    fails. Blank lines are skipped, as that reader does.
    """
    reader = spark.read.schema(T.StructType([T.StructField(header, T.StringType())])).option("header", True).option(
        "enforceSchema", not check_header).option("sep", _NO_SEPARATOR).option("quote", "").option("mode", "FAILFAST")
    column = "`" + header.replace("`", "``") + "`"
    return reader.csv(path).select(F.col(column).alias("value"), F.col("_metadata.file_path").alias(FILE))


def _split(lines: DataFrame, names: list[str], sep: str, quote: str) -> DataFrame:
    """``lines`` with their strings ``f`` and how many there are, ``n`` (another number than ``names`` has: malformed).

    Without quotes a line splits like Java's ``String.split`` (trailing empty
    fields dropped); quotes are taken off by Spark's CSV expression.
    """
    if not quote:
        s = re.escape(sep)
        return lines.withColumn("f", F.split(F.regexp_replace("value", f"({s})+$", ""), s)).withColumn("n", F.size("f"))
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    row = F.from_csv("value", ddl + ", `_malformed` string", {
        "sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    return lines.withColumn("r", row).withColumn(
        "f", F.array(*[F.col(f"r.`{n.replace('`', '``')}`") for n in names])).withColumn(
        "n", F.when(F.col("r._malformed").isNull(), len(names)).otherwise(-1)).drop("r")


def _parsed(lines: DataFrame, names: list[str], sep: str, quote: str) -> DataFrame:
    """(first, numbers, value, file, why): every field cast once; ``why`` is null for a good line."""
    numbers = F.transform(F.slice("f", 2, max(0, len(names) - 1)), lambda x: x.try_cast("double"))
    rows = _split(lines, names, sep, quote).select(F.get("f", F.lit(0)).alias("first"), numbers.alias("numbers"), "n", "value", FILE)
    at = F.array_position(F.transform("numbers", lambda x: x.isNull()), True)
    bad = F.get(F.array(*[F.lit(n) for n in names]), at.cast("int"))
    return rows.withColumn("why", F.when(F.col("n") != len(names), f"not {len(names)} fields").when(
        F.exists("numbers", lambda x: x.isNull()), F.concat(F.lit("bad or empty number: "), bad)))


def _columns(names: list[str]) -> list:
    return [F.col("first").alias(names[0]), *[F.get("numbers", F.lit(i)).alias(n) for i, n in enumerate(names[1:])]]


def _header(spark: SparkSession, path: str | list[str], sep: str, quote: str) -> tuple[str, list[str]]:
    header = _first_line(spark, path)
    names = _drop_empty_tail(header.split(sep))
    if quote:
        names = [n[1:-1] if len(n) > 1 and n[0] == n[-1] == quote else n for n in names]
    schema_from_header(names)
    return header, names


def read_wide_csv(spark: SparkSession, path: str | list[str], *, sep: str = ",", quote: str = "",
                  strict: bool = True) -> tuple[list[str], DataFrame]:
    """(names, frame) of a CSV whose header fixes the schema.

    Quotes are data by default (``quote=''``): a field ``"2003"`` stays
    ``"2003"`` with its quotes; pass ``quote='"'`` to strip them. Each file's
    first line is its header and is skipped by its place, so a folder of part
    files reads right and a later line that equals the header is data; trailing
    empty names and fields are dropped, blank lines skipped.

    A wrong number of fields, a bad or empty number, or a file with another
    header fails the job whatever columns are read: the check is a filter over
    all fields, which column pruning cannot remove. ``strict=False`` saves the
    check; bad numbers are null then, and so are missing fields.
    """
    header, names = _header(spark, path, sep, quote)
    rows = _parsed(_data_lines(spark, path, header, strict), names, sep, quote)
    if strict:
        # The partition's number keeps the filter above the projection: pushed below, it would cast every field again.
        rows = rows.withColumn("here", F.spark_partition_id())
        fail = F.raise_error(F.concat(F.col("why"), F.lit(" in: "), F.substring("value", 1, 200)))
        rows = rows.where(F.when(F.col("why").isNull() & (F.col("here") >= 0), F.lit(True)).otherwise(fail.cast("boolean")))
    return names, rows.select(*_columns(names))


def load_wide_csv(spark: SparkSession, path: str | list[str], out: str, *, sep: str = ",", quote: str = "",
                  max_bad: int | None = None) -> tuple[list[str], Loaded]:
    """(names, tables): the rows of ``read_wide_csv`` as a table below ``out``, bad lines as another, written in one scan.

    The reason of a bad line names its first bad column. A file with another
    header still fails.
    """
    header, names = _header(spark, path, sep, quote)
    rows = _parsed(_data_lines(spark, path, header, True), names, sep, quote)
    return names, set_aside(rows.select(*_columns(names), F.col("value").alias(RAW), F.col("why").alias(REASON), FILE), out, max_bad=max_bad)


def write_wide_csv(df: DataFrame, path: str, *, sep: str = ",") -> None:
    """Write a frame as CSV with one header line per part file."""
    df.write.option("header", True).option("sep", sep).option("quote", "\u0000").csv(path)
