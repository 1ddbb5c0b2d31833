"""Rank a list of terms by the number of documents that mention them; inverted index.

A document mentions a term when the term is one of its blank-separated tokens
(case-sensitive, whole token). All variants scan the documents once: the
matching terms of each document are found with one hash intersection and
exploded, so the shuffle carries (term, partial count) pairs only. Hot terms
cost nothing extra: partial aggregation folds them per task before the
exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import DEFAULT_SEPARATOR, has_token, matching_terms, tokens, validate_terms

def mention_count(docs: DataFrame, term: str, *, text_col: str = "text",
                  sep: str = DEFAULT_SEPARATOR) -> DataFrame:
    """One row (term, n_docs): documents whose text has ``term`` as a token; 0 when none."""
    validate_terms([term])
    return docs.where(has_token(text_col, term, sep)).agg(
        F.lit(term).alias("term"), F.count(F.lit(1)).alias("n_docs"))


def _doc_terms(docs: DataFrame, terms: Sequence[str], text_col: str, sep: str, by_join: bool,
               keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., term) once per document and matching term."""
    if not by_join:
        return docs.select(*keep, F.explode(matching_terms(text_col, terms, sep)).alias("term"))
    # Distinct tokens per document joined to the term table; whether that is
    # broadcast is decided by its size in bytes (the planner's threshold, AQE).
    toks = docs.select(*keep, F.explode(F.array_distinct(tokens(text_col, sep))).alias("term"))
    return toks.join(_term_table(docs, terms).select("term"), "term").select(*keep, "term")


def _term_table(docs: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(ord, term) rows of the caller's list."""
    return docs.sparkSession.createDataFrame(list(enumerate(terms)), "ord int, term string")


def rank_terms(docs: DataFrame, terms: Sequence[str], *, keep_zero: bool = True, by_join: bool = False,
               text_col: str = "text", sep: str = DEFAULT_SEPARATOR) -> DataFrame:
    """(term, n_docs) sorted by count descending.

    ``keep_zero=True`` lists every term, zeros included, ties in list order;
    ``keep_zero=False`` lists only terms with hits, ties by term. The list is
    a literal in the scan's projection; ``by_join=True`` joins the documents'
    tokens to it as a table instead, for lists of many thousands of terms.
    """
    terms = validate_terms(terms)
    hits = (_doc_terms(docs, terms, text_col, sep, by_join)
            .groupBy("term").agg(F.count(F.lit(1)).alias("n_docs")))
    if not keep_zero:
        return hits.orderBy(F.desc("n_docs"), F.asc("term"))
    ranked = (_term_table(docs, terms)
              .join(hits, "term", "left")
              .select("term", F.coalesce(F.col("n_docs"), F.lit(0).cast("bigint")).alias("n_docs"), "ord"))
    return ranked.orderBy(F.desc("n_docs"), F.asc("ord")).drop("ord")


def build_index(docs: DataFrame, terms: Sequence[str], *, id_col: str = "doc_id",
                text_col: str = "text", carry: Sequence[str] = (), by_join: bool = False,
                sep: str = DEFAULT_SEPARATOR) -> DataFrame:
    """Flat postings (term, id, carry...): one row per term and mentioning document.

    Terms without hits are absent. Postings stay flat rather than one array per
    term, because a frequent term's list would outgrow any single task; write
    them partitioned by term to get per-term files.
    """
    terms = validate_terms(terms)
    keep = [id_col, *carry]
    return _doc_terms(docs, terms, text_col, sep, by_join, keep=keep).select("term", *keep)


# Ids per page of the nested index: no posting array grows beyond this.
INDEX_PAGE_SIZE = 100_000


def build_index_pages(docs: DataFrame, terms: Sequence[str], *, id_col: str = "doc_id",
                      page_size: int = INDEX_PAGE_SIZE, text_col: str = "text",
                      sep: str = DEFAULT_SEPARATOR) -> DataFrame:
    """(term, page, doc_ids): the nested index, cut into pages of the id range.

    Page p of a term holds its documents with ids in [p * page_size,
    (p + 1) * page_size), sorted. One array per term would put a frequent
    term's whole list in one task; a page never holds more than
    ``page_size`` ids, and a hot term spreads over many (term, page) groups.
    Ids must be integers.
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{id_col!r} must be an integer column to be paged")
    postings = build_index(docs, terms, id_col=id_col, text_col=text_col, sep=sep)
    # Floor in integers: doubles would put neighbouring ids beyond 2**53 on one page.
    page = F.expr(f"(cast(`{id_col}` as bigint) - pmod(cast(`{id_col}` as bigint), {page_size}L)) div {page_size}L")
    return (postings.groupBy("term", page.alias("page"))
            .agg(F.array_sort(F.collect_list(id_col)).alias("doc_ids")))


def rank_from_index(index: DataFrame, *, term_col: str = "term", pages: bool = False) -> DataFrame:
    """(term, n_docs) from flat postings or, with ``pages=True``, index pages; count descending, ties by term."""
    if pages:
        counts = index.groupBy(term_col).agg(F.sum(F.size("doc_ids")).cast("bigint").alias("n_docs"))
    else:
        counts = index.groupBy(term_col).agg(F.count(F.lit(1)).alias("n_docs"))
    return (counts.withColumnRenamed(term_col, "term")
            .orderBy(F.desc("n_docs"), F.asc("term")))
