"""One-line markup: split a string column into (title, text) around a marker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.aside import FILE, RAW, REASON, Loaded, kept, lines_with_file, set_aside

# Layout of a one-line article record.
ARTICLE_MARKER = "</title><text>"
ARTICLE_PREFIX_LEN = 14
ARTICLE_SUFFIX_LEN = 16


def _parts(s: Column, marker: str, prefix_len: int, suffix_len: int, start_marker: str | None):
    """(title, text, no start, no marker, too short) of a markup string."""
    i = F.instr(s, marker)                                   # 1-based, 0 when absent
    if start_marker is not None:
        sm = F.instr(s, start_marker)
        start, no_start = sm + F.lit(len(start_marker)), sm == 0
    else:
        start, no_start = F.lit(prefix_len + 1), F.lit(False)
    text_start = i + F.lit(len(marker))
    text_len = F.length(s) - F.lit(suffix_len) - text_start + F.lit(1)
    return s.substr(start, i - start), s.substr(text_start, text_len), no_start, i == 0, (i < start) | (text_len < 0)


def mark_marked(df: DataFrame, col: str = "value", *, marker: str = ARTICLE_MARKER, prefix_len: int = ARTICLE_PREFIX_LEN,
                suffix_len: int = ARTICLE_SUFFIX_LEN, start_marker: str | None = None, keep: Sequence[str] = (),
                title_col: str = "title", text_col: str = "text") -> DataFrame:
    """The columns of ``extract_marked``, the string as ``raw`` and why it has no parts as ``reason`` (null if it has)."""
    s = F.col(col)
    title, text, no_start, no_marker, short = _parts(s, marker, prefix_len, suffix_len, start_marker)
    why = (F.when(s.isNull(), "null line").when(no_start, "no start marker").when(no_marker, "no marker").when(short, "too short"))
    return df.select(*keep, title.alias(title_col), text.alias(text_col), s.alias(RAW), why.alias(REASON), *kept(df, [FILE]))


def load_marked(spark: SparkSession, path: str | list[str], out: str, *, max_bad: int | None = None, **layout) -> Loaded:
    """(title, text) of the files' lines as a table below ``out``, lines without these parts as another, in one scan."""
    return set_aside(mark_marked(lines_with_file(spark, path), **layout), out, max_bad=max_bad)


def extract_marked(df: DataFrame, col: str = "value", *, marker: str = ARTICLE_MARKER,
                   prefix_len: int = ARTICLE_PREFIX_LEN, suffix_len: int = ARTICLE_SUFFIX_LEN,
                   start_marker: str | None = None, on_error: str = "raise",
                   keep: Sequence[str] = (), title_col: str = "title", text_col: str = "text") -> DataFrame:
    """(keep..., title, text) from a markup string.

    title: from character ``prefix_len`` (0-based) -- or just after the first
    ``start_marker`` when one is given -- up to the first ``marker``.
    text: after the marker, minus the last ``suffix_len`` characters.

    A missing marker, a line too short for the slices or a null line is an
    error: Spark's ``instr``/``substring`` would silently answer 0, '' or null.
    ``on_error='raise'`` fails the job, ``'null'`` yields null title and text,
    ``'drop'`` removes the row.
    """
    if on_error not in ("raise", "null", "drop"):
        raise ValueError("on_error must be 'raise', 'null' or 'drop'")
    s = F.col(col)
    title, text, no_start, no_marker, short = _parts(s, marker, prefix_len, suffix_len, start_marker)
    bad: Column = F.coalesce(no_start | no_marker | short, F.lit(True))

    if on_error == "drop":
        # The substring test is implied by ~bad; it is there to reach the reader.
        return (df.where(s.contains(marker) & ~bad)
                .select(*keep, title.alias(title_col), text.alias(text_col)))
    if on_error == "null":
        fail = F.lit(None)
    else:
        fail = F.raise_error(F.concat(
            F.lit(f"markup without '{marker}' or too short: "), F.coalesce(F.substring(s, 1, 80), F.lit("null"))))
    return df.select(*keep,
                     F.when(bad, fail).otherwise(title).alias(title_col),
                     F.when(bad, F.lit(None)).otherwise(text).alias(text_col))
