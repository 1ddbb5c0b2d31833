"""Mentions of very long term lists: a serialised membership filter drops tokens in the scan.

Terms come as a table. Its filter (a Bloom filter in 64-bit words, ``bits`` bits
a term) is built by two aggregates and reaches the scan as one value, as a
scalar subquery; tokens that it rules out are never exploded, let alone
shuffled. The join with the table takes out what it lets through wrongly, so the
result is exact, and the same with no filter at all: a list whose filter would
pass ``max_bytes`` goes without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import DEFAULT_SEPARATOR, tokens
from tessera.session import materialize

#: Bits of a term, and how many of them it sets.
BITS = 16
PROBES = 4
#: A larger filter is not built.
MAX_BYTES = 64 << 20


def _places(term: Column, words: int) -> list[tuple[Column, Column]]:
    """(word, bit) of every probe of a term."""
    out = []
    for seed in range(PROBES // 2):
        h = F.xxhash64(term, F.lit(seed))
        out += [(F.shiftrightunsigned(h, 32), h.bitwiseAND(63)), (F.shiftrightunsigned(h, 6).bitwiseAND((1 << 26) - 1), F.shiftrightunsigned(h, 58))]
    return [(F.pmod(word, F.lit(words)), bit.cast("int")) for word, bit in out]


def build_filter(terms: DataFrame, words: int, *, term_col: str = "term") -> DataFrame:
    """One row (bits): the filter of the terms as an array of ``words`` longs."""
    one = F.lit(1).cast("bigint")
    pairs = F.array(*[F.struct(w.alias("word"), F.call_function("shiftleft", one, bit).alias("bit"))
                      for w, bit in _places(F.col(term_col), words)])
    set_bits = terms.select(F.explode(pairs).alias("p")).groupBy(F.col("p.word").alias("word")).agg(
        F.bit_or("p.bit").alias("bits"))
    every = terms.sparkSession.range(words).join(set_bits, F.col("id") == F.col("word"), "left")
    # Bounded by the caller: one row of ``words`` longs.
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                 lambda x: x["bits"]).alias("bits"))


def _admitted(term: Column, bits: Column, words: int) -> Column:
    hits = None
    for word, bit in _places(term, words):
        hit = F.call_function("shiftrightunsigned", F.get(bits, word.cast("int")), bit).bitwiseAND(1) == 1
        hits = hit if hits is None else hits & hit
    return hits


def doc_tokens(docs: DataFrame, terms: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", term_col: str = "term",
               sep: str = DEFAULT_SEPARATOR, bits: int = BITS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(id, term): each document's distinct tokens that the terms' filter admits, or all where there is none."""
    words = max(1, -(-terms.count() * bits // 64))
    distinct = F.array_distinct(tokens(text_col, sep))
    if 8 * words > max_bytes:
        return docs.select(id_col, F.explode(distinct).alias("term"))
    # Written: the filter is the same however often the scan is retried.
    built = materialize(build_filter(terms, words, term_col=term_col), "term-filter")
    shown = docs.select(F.col(id_col).alias("id"), distinct.alias("tokens"))
    with_bits = shown.sparkSession.sql("SELECT id, tokens, (SELECT bits FROM {built}) AS bits FROM {shown}", built=built, shown=shown)
    kept = F.filter("tokens", lambda t: _admitted(t, F.col("bits"), words))
    return with_bits.select(F.col("id").alias(id_col), F.explode(kept).alias("term"))


def rank_term_table(docs: DataFrame, terms: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", term_col: str = "term",
                    sep: str = DEFAULT_SEPARATOR, bits: int = BITS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(term, n_docs) of the terms that documents mention, for tables of millions of terms; ties by term.

    Repeated terms count once, null and empty ones not at all.
    """
    wanted = materialize(terms.select(F.col(term_col).alias("term")).where("term <> ''").distinct(), "terms")
    found = doc_tokens(docs, wanted, id_col=id_col, text_col=text_col, sep=sep, bits=bits, max_bytes=max_bytes)
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.join(wanted, "term", "left_semi").orderBy(F.desc("n_docs"), F.asc("term"))
