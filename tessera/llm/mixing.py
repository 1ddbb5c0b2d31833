"""Mixing sources to target weights, in fixed-length blocks.

Each source's documents, laid end to end, are packed into blocks of ``BLOCK``
words. A source's quota of output slots is its target in blocks. Every slot
draws its output shard by hash, so that a source's counts over the shards are
one multinomial draw (``shard_counts``) that adds up to the quota. Slot j of a
source of n blocks reads block perm(j mod n), where perm is a pseudorandom
permutation of the n indices keyed by the seed, the source and the turn j div n;
so no block is read a second time before all were read once. Slots meet the
blocks by a join on (source, block index): ``mixed_blocks`` are the mix itself,
and what each document gives (``report``) and its mixed text (``apply``) come
from the same joined slots.

The permutation is swap-or-not: in each of ``ROUNDS`` rounds index x and its
mirror K - x mod n change places or not by a bit of the larger of the two. It
permutes any range of indices as it is and needs whole-number arithmetic only.

Everything is DataFrame functions, and all arithmetic is on integers or exact
doubles, so reruns agree. No step holds a source together: running offsets are
summed within the partitions of a range partitioning, then over the partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import as_row, partitions, stored

BLOCK = 64
SHARD_SLOTS = 8192
SLOTS_PER_TASK = 65536
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
ROUNDS = 24
#: Fixed values of the permutation's bit: a prime, a multiplier, and where the bit is taken.
PRIME, FACTOR, MIDDLE = 2_147_483_647, 48_271, 65_536
BLANKS = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09 to 0x0D; 0 for null."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(inner, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


@dataclass
class Mix:
    """rows: row, doc_id, th, source, size, rank, start. sources: source, rank, size, target, blocks, slots.
    drawn: rank, turn, block, shard, draw, one row a slot. pieces: row, rank, block, at, n, times, shard
    (times: slots that read the piece's block, shard: the first of theirs)."""

    rows: DataFrame
    sources: DataFrame
    drawn: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, rank, size, target, blocks, slots) from (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and get
    ``share`` times all sizes by weight, none more than ``limit`` times its own
    size. The excess goes to the others by weight until none is above: with the
    sources sorted by limit per weight, the ones before the level are full and
    the level serves the rest. One row a source; windows over them are small.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("size"))
    everyone = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.lit(list(weights)), ((F.col("rank") - 1) % len(weights)) + 1).cast("double")
    s = total.withColumn("rank", F.row_number().over(everyone)).withColumn("w", w).withColumn("full", limit * F.col("size").cast("double"))
    by_ratio = Window.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("ratio", F.col("full") / F.col("w")).withColumn(
        "level", (share * F.sum("size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    # The first source, by ratio, that the level leaves unfilled sets it.
    s = s.withColumn("place", F.row_number().over(by_ratio)).withColumn(
        "first", F.min(F.when(F.col("ratio") >= F.col("level"), F.col("place"))).over(every))
    s = s.withColumn("water", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(every))
    s = s.withColumn("target", F.when(F.col("place") < F.coalesce("first", F.lit(1 << 30)), F.col("full")).otherwise(
        F.col("water") * F.col("w")))
    blocks = F.expr(f"(size + {BLOCK - 1}) div {BLOCK}")
    return s.withColumn("blocks", blocks).withColumn(
        "slots", F.when(F.col("size") > 0, F.least(F.col("blocks") * int(limit), F.floor(
            F.col("target") * F.col("blocks") / F.col("size") + F.lit(0.5)))).otherwise(0).cast("long")).select(
        "source", "rank", "size", "target", "blocks", "slots")


def _offsets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with ``start``: the words of the source before each row, by (doc_id, size, text hash), nulls first.

    A row repeated any number of times spreads over partitions by its row number.
    """
    order = ["rank", "doc_id", "size", "th", "row"]
    laid = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()), "mix-laid").withColumn("part", F.expr("shiftright(at, 33)"))
    inside = F.sum("size").over(Window.partitionBy("part").orderBy("at")) - F.col("size")
    # One row a partition, and one a source.
    parts = laid.groupBy("part").agg(F.sum("size").alias("s"))
    parts = parts.select("part", (F.sum("s").over(Window.orderBy("part")) - F.col("s")).alias("before"))
    first = sources.select("rank", (F.sum("size").over(Window.orderBy("rank")) - F.col("size")).alias("first"))
    return laid.withColumn("inside", inside).join(parts, "part").join(first, "rank").withColumn(
        "start", F.expr("before + inside - first")).drop("at", "part", "inside", "before", "first")


def permuted(index: str, n: str, keys: str) -> Column:
    """The place of ``index`` (0 to n - 1) under the permutation of n indices that the array ``keys`` fixes."""
    mirror = f"pmod(k - x, {n})"
    larger = f"greatest(x, {mirror})"
    u = f"(({larger} % {PRIME}) * {FACTOR} + {larger} div {PRIME} + k % {PRIME}) % {PRIME}"
    bit = f"transform(array({u}), u -> ((u * u) % {PRIME}) div {MIDDLE} % 2)[0]"
    return F.expr(f"aggregate({keys}, {index}, (x, k) -> if({bit} = 1, {mirror}, x))")


def _hash(*parts: str) -> str:
    """SQL of a 52-bit number from the texts of ``parts``."""
    return f"cast(conv(substr(md5(concat_ws('#', {', '.join(parts)})), 1, 13), 16, 10) as bigint)"


def _slots(sources: DataFrame, seed: int) -> DataFrame:
    """(rank, turn, block, shard, draw) of every slot; ``draw`` orders the slots of a shard."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // SHARD_SLOTS))
    n = partitions(sources.sparkSession)
    s = sources.filter("slots > 0").withColumn("turn", F.explode(F.expr("sequence(0L, (slots - 1) div blocks)")))
    s = s.withColumn("here", F.expr("least(blocks, slots - turn * blocks)")).withColumn(
        "run", F.explode(F.expr(f"sequence(0L, (here - 1) div {SLOTS_PER_TASK})")))
    s = s.withColumn("keys", F.expr(f"transform(sequence(1, {ROUNDS}), r -> {_hash(str(seed), 'rank', 'turn', 'r')})"))
    s = s.repartition(n, "rank", "turn", "run").withColumn("i", F.explode_outer(F.expr(
        f"sequence(run * {SLOTS_PER_TASK}, least(here, (run + 1) * {SLOTS_PER_TASK}) - 1)")))
    return s.select("rank", "turn", permuted("i", "blocks", "keys").alias("block"), F.expr(
        _hash(f"'{seed}:shard'", "rank", "turn", "i")).alias("draw")).withColumn("shard", F.expr(f"cast(draw % {shards} as int)"))


def mix(docs: DataFrame, *, seed: int = 11, **options) -> Mix:
    """Draws the mix of all ``docs`` (doc_id, text, source).

    Null texts have no words; null sources are one source, ordered last; null
    ids and repeated rows are rows like others. A source without words gets
    nothing. An empty table gives empty frames.
    """
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"),
        F.col("source").cast("string").alias("source"), n_words(F.col("text").cast("string")).alias("size"),
    ).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    sources = stored(targets(rows.select("source", "size"), **options), "mix-sources")
    ranks = sources.select(F.col("source").alias("of"), "rank")
    rows = stored(_offsets(rows.join(ranks, F.expr("source <=> of")).drop("of"), sources), "mix-offsets")
    drawn = _slots(sources, seed)
    # Exploded rows are planned at the size of the few they come from: without the merge hints they would be broadcast.
    taken = drawn.groupBy("rank", "block").agg(F.count("*").alias("times"), F.min("shard").alias("shard")).hint("merge")
    ends = f"(start + size - 1) div {BLOCK}"
    spread = rows.filter("size > 0").select("row", "rank", "start", "size", F.explode_outer(
        F.expr(f"sequence(start div {BLOCK}, {ends})")).alias("block"))
    low, high = f"greatest(start, block * {BLOCK})", f"least(start + size, (block + 1) * {BLOCK})"
    pieces = spread.join(taken, ["rank", "block"]).select(
        "row", "rank", "block", F.expr(f"{low} - start").alias("at"), F.expr(f"{high} - {low}").alias("n"), "times", "shard")
    return Mix(rows, sources, drawn, pieces)


def shard_counts(m: Mix) -> DataFrame:
    """(shard, source, slots): the sources' multinomial counts in each output shard."""
    return m.drawn.groupBy("shard", "rank").agg(F.count("*").alias("slots")).join(
        m.sources.select("rank", "source"), "rank").select("shard", "source", "slots")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_shard of every row of ``docs``.

    ``first_shard`` is the first output shard with words of the row, -1 where the mix takes none.
    """
    m = mix(docs, **options)
    taken = m.pieces.groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("taken"), F.min("shard").alias("first_shard")).hint("merge")
    s = m.sources.select("rank", F.col("size").alias("source_size"), "target")
    return m.rows.join(taken, "row", "left").join(s, "rank").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("first_shard", F.lit(-1)).alias("first_shard"))


def _with_words(docs: DataFrame, m: Mix, parts: DataFrame) -> DataFrame:
    """``parts`` (row, ...) with the row's document ``doc`` and its words.

    Rows alike in id, text and source share one of their documents.
    """
    text = F.col("text").cast("string")
    d = docs.select(as_row(docs, "doc"), F.xxhash64(text).alias("key"), F.col("doc_id").cast("long").alias("id"),
                    F.col("source").cast("string").alias("from"))
    once = Window.partitionBy("key", "id", "from").orderBy(F.xxhash64("doc"))
    d = d.withColumn("nth", F.row_number().over(once)).filter("nth = 1").drop("nth")
    keys = m.rows.select("row", "doc_id", "th", "source")
    out = d.join(parts.join(keys.hint("merge"), "row").hint("merge"), F.expr("key = th and id <=> doc_id and `from` <=> source"))
    return out.withColumn("words", F.split(F.btrim(F.col("doc.text").cast("string"), F.lit(BLANKS)), r"[\x20\x09-\x0D]+"))


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix: shard, slot, source, block, n_words, text of every slot; slots count from 0 in their shard.

    A block's text is its words in the order of its source, joined by spaces;
    it has ``BLOCK`` words, fewer at a source's end. Shards hold some
    ``SHARD_SLOTS`` slots each, so numbering them is a small sort.
    """
    m = mix(docs, **options)
    parts = m.pieces.groupBy("row").agg(  # of one row
        F.collect_list(F.struct("rank", "block", "at", "n")).alias("parts"))
    cut = _with_words(docs, m, parts).withColumn("piece", F.explode_outer(F.expr(
        """if(size(words) > 0, transform(parts, p -> named_struct('rank', p.rank, 'block', p.block, 'n', p.n,
               'text', array_join(slice(words, cast(p.at + 1 as int), cast(p.n as int)), ' '))), null)""")))
    starts = m.rows.select("row", "start").hint("merge")
    blocks = cut.select("row", "piece.*").join(starts, "row").groupBy("rank", "block").agg(  # at most BLOCK words
        F.sum("n").alias("n_words"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "row", "text"))),
                                                              lambda x: x["text"]), " ").alias("text"))
    place = Window.partitionBy("shard").orderBy("draw", "rank", "turn", "block")
    slots = m.drawn.withColumn("slot", F.row_number().over(place) - 1)
    return slots.hint("merge").join(blocks.hint("merge"), ["rank", "block"]).join(m.sources.select("rank", "source"), "rank").select(
        "shard", "slot", "source", "block", "n_words", "text")


def apply(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``.

    A row comes out once with the words the mix takes, in their order and
    joined by spaces, and a second time with those it takes twice; rows it
    takes nothing of go. ``n_chars`` is set anew where there is such a column.
    Rows alike in doc_id, source and text take their other columns from one of them.
    """
    m = mix(docs, **options)
    parts = m.pieces.withColumn("turn", F.explode_outer(F.expr("sequence(1L, times)"))).groupBy("row", "turn").agg(  # of one row
        F.sort_array(F.collect_list(F.struct("at", "n"))).alias("parts"))
    out = _with_words(docs, m, parts)
    # The words are named twice, or their split would be planned into the lambda, once for every piece.
    out = out.withColumn("mixed", F.expr(
        """if(size(words) > 0,
              array_join(flatten(transform(parts, p -> slice(words, cast(p.at + 1 as int), cast(p.n as int)))), ' '), '')"""))
    doc = F.col("doc").withField("text", F.col("mixed"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("mixed").cast(docs.schema["n_chars"].dataType))
    return out.select(doc.alias("doc")).select("doc.*")
