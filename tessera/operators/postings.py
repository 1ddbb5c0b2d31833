"""Inverted index in blocks: delta-coded ids behind headers that answer counts and let queries skip.

A block holds up to ``block_size`` ascending ids of one term, all from one page
of the id range: (term, page, first_id, last_id, n, deltas). The first three
beside the count are its header. Counting reads headers only, the deltas' column
is pruned from the scan; an intersection joins the headers of two terms by page
and overlap, and decodes the blocks that are left. Pages bound every array and
spread a term of a third of all documents over as many groups as it has pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_SIZE = 128
#: Ids of a page: its range, and so the most that one group collects.
PAGE_SIZE = 1 << 16


def encode_ids(ids: Column) -> Column:
    """The gaps between ascending ids of one page, the first id's being 0."""
    return F.transform(ids, lambda x, i: F.when(i == 0, 0).otherwise((x - F.get(ids, i - 1)).cast("int")))


def decode_ids(first: Column, deltas: Column) -> Column:
    """The ids of a block from its first id and its gaps (arrays of a block's size are what the running sum copies)."""
    start = F.slice(F.array(first.cast("bigint")), 1, 0)
    return F.aggregate(deltas, start, lambda ids, d: F.concat(ids, F.array(F.coalesce(F.get(ids, F.size(ids) - 1), first) + d)))


def build_blocks(postings: DataFrame, *, id_col: str = "doc_id", block_size: int = BLOCK_SIZE, page_size: int = PAGE_SIZE) -> DataFrame:
    """(term, page, first_id, last_id, n, deltas) from flat postings (term, id): the blocks of every term.

    Ids are integers; a posting given twice counts once, null ids are left out.
    """
    if block_size < 1 or not 1 <= page_size <= 1 << 31:
        raise ValueError("block_size must be positive and page_size between 1 and 2 ** 31")
    if not isinstance(postings.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{id_col!r} must be an integer column")
    flat = postings.select("term", F.col(id_col).cast("bigint").alias("id")).where("id is not null")
    # Floor in integers: doubles would put neighbouring ids beyond 2**53 on one page.
    page = F.expr(f"(id - pmod(id, {page_size}L)) div {page_size}L")
    pages = flat.groupBy("term", page.alias("page")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    cuts = F.expr(f"transform(sequence(1, size(ids), {block_size}), i -> slice(ids, i, {block_size}))")
    blocks = pages.select("term", "page", F.explode(cuts).alias("ids"))
    return blocks.select("term", "page", F.get("ids", F.lit(0)).alias("first_id"), F.element_at("ids", -1).alias("last_id"),
                         F.size("ids").alias("n"), encode_ids(F.col("ids")).alias("deltas"))


def postings_of(blocks: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The flat postings (term, id) of blocks."""
    return blocks.select("term", F.explode(decode_ids(F.col("first_id"), F.col("deltas"))).alias(id_col))


def rank_from_blocks(blocks: DataFrame) -> DataFrame:
    """(term, n_docs) from the headers; count descending, ties by term."""
    counts = blocks.groupBy("term").agg(F.sum("n").cast("bigint").alias("n_docs"))
    return counts.orderBy(F.desc("n_docs"), F.asc("term"))


def overlapping(blocks: DataFrame, one: str, other: str) -> DataFrame:
    """(page, first_id, deltas, other_first, other_deltas): pairs of blocks of two terms whose id ranges meet."""
    a = blocks.where(F.col("term") == one).select("page", "first_id", "last_id", "deltas")
    b = blocks.where(F.col("term") == other).select(
        F.col("page").alias("other_page"), F.col("first_id").alias("other_first"), F.col("last_id").alias("other_last"),
        F.col("deltas").alias("other_deltas"))
    return a.join(b, F.expr("page = other_page and first_id <= other_last and other_first <= last_id")).select(
        "page", "first_id", "deltas", "other_first", "other_deltas")


def intersect_terms(blocks: DataFrame, one: str, other: str, *, id_col: str = "doc_id") -> DataFrame:
    """The ids in both terms' postings; blocks that no block of the other term meets are not decoded."""
    met = overlapping(blocks, one, other)
    both = F.array_intersect(decode_ids(F.col("first_id"), F.col("deltas")), decode_ids(F.col("other_first"), F.col("other_deltas")))
    return met.select(F.explode(both).alias(id_col))
