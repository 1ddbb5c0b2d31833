"""Line-oriented text sources: plain lines and header-less comma-separated posts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.aside import FILE, RAW, REASON, Loaded, kept, lines_with_file, set_aside

POSTS_SCHEMA = "ptype int, id bigint, accepted bigint, parent bigint, score int, tag string"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row (``value``) per line; Spark picks the splits."""
    return spark.read.text(path)


# Fixed value: an integer field is an optional sign and ASCII digits, nothing
# else (Spark's cast would also accept surrounding blanks and control chars).
INT_PATTERN = "^[+-]?[0-9]+$"
# Fields of a line and their types; accepted and parent may be empty.
_INT_FIELDS = (("ptype", "int"), ("id", "bigint"), ("accepted", "bigint"), ("parent", "bigint"), ("score", "int"))
_OPTIONAL = ("accepted", "parent")


def _number(s: Column, dtype: str) -> Column:
    """The field as a number; null for anything that is not one."""
    return F.when(s.rlike(INT_PATTERN), s.try_cast(dtype))


def _plain_line(sep: str) -> str:
    """Lines whose numbers are right whatever the type: few enough digits to fit."""
    short, long = "[+-]?[0-9]{1,9}", "[+-]?[0-9]{1,18}"
    return f"^{short}{sep}{long}{sep}({long})?{sep}({long})?{sep}{short}({sep}.*)?$"


def _fields(line: Column, s: str) -> Column:
    """Fields of a line, trailing empty ones dropped."""
    return F.split(F.regexp_replace(line, f"(?:{s})+$", ""), s)


def _post(fields: Column) -> list[Column]:
    return [*[_number(F.get(fields, F.lit(i)), dtype).alias(name) for i, (name, dtype) in enumerate(_INT_FIELDS)],
            F.get(fields, F.lit(5)).alias("tag")]


def _wrong(fields: Column, i: int) -> Column:
    name, dtype = _INT_FIELDS[i]
    f = F.get(fields, F.lit(i))
    wrong = _number(f, dtype).isNull()
    return (f != "") & wrong if name in _OPTIONAL else wrong


def mark_posts(lines: DataFrame, col: str = "value", *, sep: str = ",") -> DataFrame:
    """The columns of ``parse_posts``, the line as ``raw`` and why it is no post as ``reason`` (null if it is one).

    The reason names the first thing wrong: a null line, fewer than five fields,
    or the first field that is not a number. A ``file`` column is kept.
    """
    line, s = F.col(col), re.escape(sep)
    fields = _fields(line, s)
    why = F.when(line.isNull(), "null line").when(F.size(fields) < 5, "fewer than 5 fields")
    for i, (name, _) in enumerate(_INT_FIELDS):
        why = why.when(_wrong(fields, i), f"bad number: {name}")
    plain = F.coalesce(line.rlike(_plain_line(s)), F.lit(False))  # nearly every line; only the others are taken apart for a reason
    return lines.select(*_post(fields), line.alias(RAW), F.when(~plain, why).alias(REASON), *kept(lines, [FILE]))


def load_posts(spark: SparkSession, path: str | list[str], out: str, *, sep: str = ",", max_bad: int | None = None) -> Loaded:
    """Posts of the files as a table below ``out``, lines that are none as another, written in one scan."""
    return set_aside(mark_posts(lines_with_file(spark, path), sep=sep), out, max_bad=max_bad)


def parse_posts(lines: DataFrame, col: str = "value", *, sep: str = ",", strict: bool = True) -> DataFrame:
    """(ptype, id, accepted, parent, score, tag) from ``type,id,accepted,parent,score[,tag[,...]]``.

    Fields split like Java's ``String.split``: trailing empty fields are
    dropped, so a line ending in separators has fewer fields, while an empty
    field before a non-empty one stays an empty string. Empty accepted/parent
    → null; the tag is null when absent; fields past the sixth are ignored.

    Fewer than five fields, a bad number or a null line fails the job, whatever
    columns are read: the check is a filter on the line, which column pruning
    cannot remove. ``strict=False`` saves the check; bad fields are null then.
    """
    line, s = F.col(col), re.escape(sep)
    fields = _fields(line, s)
    if strict:
        bad = F.size(fields) < 5
        for i in range(len(_INT_FIELDS)):
            bad = bad | _wrong(fields, i)
        # Nearly every line passes the pattern; only the others are taken apart.
        good = F.coalesce(line.rlike(_plain_line(s)), F.lit(False)) | F.coalesce(~bad, F.lit(False))
        fail = F.raise_error(F.concat(F.lit("bad post line: "), F.coalesce(F.substring(line, 1, 200), F.lit("null"))))
        lines = lines.where(F.when(good, F.lit(True)).otherwise(fail.cast("boolean")))
    return lines.select(*_post(fields))


def read_posts(spark: SparkSession, path: str | list[str], *, strict: bool = True) -> DataFrame:
    return parse_posts(read_lines(spark, path), strict=strict)


def format_posts(posts: DataFrame, *, sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """The inverse of ``parse_posts``: one ``value`` line per post (null → empty field), beside the columns ``keep``.

    A tag with a separator or a line break would read back as something else
    and fails the job.
    """
    def field(c: str) -> Column:
        text = F.col(c).cast("string")
        if c == "tag":
            fail = F.raise_error(F.concat(F.lit("tag with a separator or line break: "), text))
            text = F.when(text.contains(sep) | text.rlike("[\\r\\n]"), fail).otherwise(text)
        return F.coalesce(text, F.lit(""))
    return posts.select(*keep, F.concat_ws(sep, *[field(c) for c in
                                           ("ptype", "id", "accepted", "parent", "score", "tag")]).alias("value"))
