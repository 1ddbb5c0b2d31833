"""Token expressions over text columns (JVM-side, codegen friendly)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col

# Fixed value: the only token separator the reference recognises is one blank.
DEFAULT_SEPARATOR = " "


def tokens(text: Column | str, sep: str = DEFAULT_SEPARATOR) -> Column:
    """Split on a literal separator, keeping empty tokens (Java keeps inner empties)."""
    return F.split(as_col(text), re.escape(sep))


def has_token(text: Column | str, term: str, sep: str = DEFAULT_SEPARATOR) -> Column:
    """True when ``term`` is a whole token: case-sensitive, ``Java,`` is not ``Java``.

    A plain substring test runs first: a document without the characters of
    the term at all is never split into tokens (for a rare term that is
    nearly every document), and the reader may receive it as a pushed filter.
    """
    t = as_col(text)
    return t.contains(F.lit(term)) & F.array_contains(tokens(t, sep), F.lit(term))


def term_array(terms: Sequence[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms])


def matching_terms(text: Column | str, terms: Sequence[str], sep: str = DEFAULT_SEPARATOR) -> Column:
    """Distinct list terms that occur as tokens of ``text``.

    ``array_intersect`` hashes the token array once and drops repeats, so a
    document counts once per term however often the token occurs.
    """
    return F.array_intersect(tokens(text, sep), term_array(terms))


def validate_terms(terms: Sequence[str]) -> list[str]:
    terms = list(terms)
    if not terms:
        raise ValueError("term list is empty")
    if len(set(terms)) != len(terms):
        raise ValueError("term list has duplicates")
    if any(not isinstance(t, str) for t in terms):
        raise TypeError("terms must be strings")
    if any(t == "" for t in terms):
        # Java's split drops trailing empty tokens and Spark's keeps them, so
        # an empty term would match differently; it is not a word anyway.
        raise ValueError("term list has an empty term")
    return terms
