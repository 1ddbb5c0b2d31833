"""N-gram Jaccard join: near-duplicate texts by a chosen-path join.

Texts are sets of hashed five-word shingles (ASCII letters in lower case,
digits and all non-ASCII characters make words). Equal sets form a class with
one representative; everything after that works on classes.

1. *Paths.* In each run a class follows one path: at every level it takes the
   token with the smallest hash under that level's hash function, so two sets
   stay together at a level with the probability of their Jaccard similarity.
   Buckets that are small are leaves; larger ones are split again, down to
   ``levels``. Runs repeat until a pair at the threshold that needs every
   level is still met with probability ``recall``.
2. *Leaves.* Small leaves are brute-forced on 64-coordinate sketches, keeping
   pairs whose estimated similarity is 0.5 or more (six standard deviations
   below 0.8). A leaf that is still large after the last level is a group of
   copies: its members are tied to its smallest one. The connected components
   of these candidate ties are clusters.
3. *Exact links.* Every cluster's shingle sets are fetched once, cut into
   blocks, and each pair of blocks is compared exactly in one task, which
   returns the number of links of each member and a spanning forest, never the
   pairs. A large group of copies is thus spread over many tasks. Blocks stay
   below a fixed size however large the cluster is, and the pairs of blocks are
   taken in rounds, so that neither a task nor the shuffle grows with its square.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import as_row, components, in_tasks, partitions, stored
from tessera.llm._text import ALNUM, LOWER, find_words, mix, pieces, runs_of, segment_hashes, shingle_sets, text_chunks

SHINGLE = 5
THRESHOLD = 0.8
LEVELS = 3
RECALL = 0.9999
SKETCH = 64
LEAF = 64
BLOCK = 128
#: Mean classes and shingles of a block at most, and copies of the sets that one round shuffles.
MOST, TOKENS, FOLD = 512, 1 << 18, 128
KEY = ["k1", "k2", "n"]


def runs_needed(threshold: float, levels: int, recall: float) -> int:
    """Runs after which a pair at the threshold has met in a leaf with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** levels))


def _coordinates(n: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(7919))
    return (a >> np.uint64(32)).astype(np.uint32) | np.uint32(1), a.astype(np.uint32)


def _sampled_tokens(tokens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest hash of the set under each of the hash functions (a, b)."""
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    x = (tokens >> np.uint64(29)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i: i + 2048]
        h = a[:, None] * part[None, :]
        h ^= b[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return least


def _sets(batch: pa.RecordBatch, width: int):
    """(row, ascending shingle hashes) of each text of the batch."""
    for row, offsets, data in text_chunks(batch.column("text")):
        data = LOWER[data]
        starts, ends, first = find_words(data, offsets, ALNUM)
        yield from enumerate(shingle_sets(segment_hashes(data, starts, ends), first, width), row)


def _key(tokens: np.ndarray) -> tuple[int, int, int]:
    """Identity of a set: two independent 64-bit sums and its size."""
    k1 = tokens.sum(dtype=np.uint64)
    k2 = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(k1.astype(np.int64)), int(k2.astype(np.int64)), len(tokens)


def signatures(docs: DataFrame, coordinates: int, width: int = SHINGLE) -> DataFrame:
    """doc_id, hash of the text, set key (k1, k2, n), sampled token per coordinate, 8-bit sketch."""
    a, b = _coordinates(max(coordinates, SKETCH))

    def compute(batches):
        for batch in batches:
            keys, samples, sketches = [], [], []
            for _, tokens in _sets(batch, width):
                keys.append(_key(tokens))
                least = _sampled_tokens(tokens, a, b)
                samples.append(least[:coordinates].astype(np.int32))
                sketches.append((mix(least[:SKETCH].astype(np.uint64)) & np.uint64(255)).astype(np.uint8))
            flat = np.concatenate(samples) if samples else np.empty(0, np.int32)
            at = np.arange(0, len(flat) + 1, coordinates, dtype=np.int32)
            cols = [batch.column("doc_id"), batch.column("hash"), *(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pieces(sketches)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "hash", *KEY, "tokens", "sketch"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("hash")).transform(
        in_tasks, compute, "doc_id long, hash long, k1 long, k2 long, n long, tokens array<int>, sketch binary")


def _forest(close: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the symmetric matrix joins, one fewer than the members of each part."""
    label = np.arange(len(close))
    edges = []
    for i in range(1, len(close)):
        for root in np.unique(label[:i][close[i, :i]]).tolist():
            edges.append((i, root))
            label[label == root] = i
    return edges


def _tie_leaves(batches):
    """Candidate ties of small leaves: batches sorted by path -> (a, b)."""
    left, right = [], []
    for leaf in runs_of(batches, ["path"]):
        node = leaf.column("node").to_numpy()
        sketch = np.frombuffer(b"".join(leaf.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(node), SKETCH)
        same = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2)
        # Unequal coordinates of an 8-bit sketch agree by chance once in 256.
        for i, j in _forest(same >= SKETCH * (0.5 + 0.5 / 256)):
            left.append(node[i])
            right.append(node[j])
        if len(left) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
            left, right = [], []
    yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = count > 1
    place = np.cumsum(useful) - 1
    keep = useful[column]
    owner, column = owner[keep], place[column[keep]]
    total = np.zeros((m, m), dtype=np.float32)
    width = max(256, (4 << 20) // m)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(useful.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((m, width), dtype=np.float32)
        dense[owner[a:b], column[a:b] - lo] = 1
        total += dense @ dense.T
    return total.astype(np.int64)


def _link_blocks(threshold: float):
    """Exact links inside each pair of blocks: (node, links, peer)."""

    def compute(batches):
        for group in runs_of(batches, ["root", "i", "j"]):
            node, where = np.unique(group.column("node").to_numpy(), return_index=True)  # a repeated row counts once
            if len(node) < 2:
                continue
            blobs = group.column("tokens").to_pylist()
            sets = [np.frombuffer(blobs[w], dtype=np.uint64) for w in where.tolist()]
            size, block = (group.column(c).to_numpy()[where] for c in ("size", "block"))
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            inter = _shared(sets)
            length = np.array([len(s) for s in sets])
            linked = inter >= threshold * (length[:, None] + length[None, :] - inter) - 1e-9
            np.fill_diagonal(linked, False)
            if i != j:
                linked &= block[:, None] != block[None, :]
            links = linked @ size
            label = np.arange(len(node))
            while True:
                low = np.minimum(label, np.where(linked, label[None, :], len(node)).min(axis=1))
                low = low[low]
                if (low == label).all():
                    break
                label = low
            has = links > 0
            if has.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[has]), pa.array(links[has].astype(np.int64)), pa.array(node[label[has]])],
                    names=["node", "links", "peer"])

    return compute


def block_count(members: Column, tokens: Column) -> Column:
    """Blocks of a cluster: about ``BLOCK`` classes each, more in clusters of many, up to ``MOST`` and ``TOKENS``."""
    return F.greatest(F.least(F.lit(BLOCK), F.ceil(members / BLOCK)), F.ceil(members / MOST), F.ceil(tokens / TOKENS)).cast("int")


def _place(sets: DataFrame, turn: int, rounds: int) -> DataFrame:
    """``sets`` once for each pair of blocks (i, j) of the round: those with i + j = turn modulo ``rounds``."""
    start = F.expr(f"cast(pmod({turn} - block, {rounds}) as int)")
    return sets.withColumn("start", start).filter("start < blocks").select(
        "root", "node", "size", "block", "tokens",
        F.explode(F.sequence("start", F.col("blocks") - 1, F.lit(rounds))).alias("other")).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", F.col("size").cast("long"), "block", "tokens")


def _grouped(docs: DataFrame, threshold: float, width: int, levels: int, recall: float, leaf: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, hash, set key) of every row, and (set key, root, class_id, n_links) of every set: ``root`` names its group."""
    spark = docs.sparkSession
    runs = runs_needed(threshold, levels, recall)
    rows = stored(signatures(docs, runs * levels, width), "ngram-signatures")
    classes = stored(
        rows.filter("n > 0").groupBy(*KEY).agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("size"),
            F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"),
        ).withColumn("node", F.monotonically_increasing_id()), "ngram-classes")

    # Recursive splitting: a leaf is a bucket of at most `leaf` members, or any bucket of the last level.
    def token(level):
        return F.expr(f"tokens[run * {levels} + {level}]")

    active = classes.select("node", "tokens", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")).select(
        "node", F.xxhash64("run", token(0)).alias("path"), *(token(k).alias(f"t{k}") for k in range(1, levels)))
    small, large = [], None
    for level in range(levels):
        met = active.groupBy("path").agg(F.count("*").alias("members")).filter("members > 1").hint("rebalance")
        met = stored(active.join(met, "path"), f"ngram-level{level}")
        small.append(met.filter(F.col("members") <= leaf).select("path", "node"))
        active = met.filter(F.col("members") > leaf).drop("members")
        if level + 1 < levels:
            active = active.withColumn("path", F.xxhash64("path", f"t{level + 1}")).drop(f"t{level + 1}")
        else:
            large = active.select("path", "node")

    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.union(more)
    by_path = partitions(spark)
    ties = leaves.join(classes.select("node", "sketch"), "node").repartition(by_path, "path").sortWithinPartitions(
        "path").transform(in_tasks, _tie_leaves, "a long, b long").distinct()
    centre = large.groupBy("path").agg(F.min("node").alias("b")).hint("rebalance")
    ties = ties.union(large.join(centre, "path").select(F.col("node").alias("a"), "b").filter("a <> b").distinct())
    clusters = stored(components(ties, "ngram-ties"), "ngram-clusters")

    # Every cluster's sets, once per pair of blocks.
    sizes = clusters.join(classes.select("node", "n"), "node").groupBy("root").agg(
        block_count(F.count("*"), F.sum("n")).alias("blocks")).hint("rebalance")
    members = stored(
        clusters.join(sizes, "root").join(classes.select("node", "rep", "size", *KEY), "node")
        .withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)")), "ngram-members")

    def sets(batches):
        for batch in batches:
            keys, tokens = [], []
            for _, t in _sets(batch, width):
                keys.append(_key(t))
                tokens.append(t)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)), pieces(tokens)], names=[*KEY, "tokens"])

    wanted = _texts_of(docs, members)
    cut = wanted.transform(in_tasks, sets, "k1 long, k2 long, n long, tokens binary").join(members, KEY).select(
        "root", "node", "size", "block", "blocks", "tokens")
    once, copies = members.agg(F.sum("n"), F.sum(F.col("n") * F.col("blocks"))).first()
    rounds = max(1, math.ceil((copies or 0) / (FOLD * (once or 1))))
    if rounds > 1:
        cut = stored(cut, "ngram-sets")
    links = None
    for turn in range(rounds):
        part = stored(
            _place(cut, turn, rounds).repartition(by_path, "root", "i", "j").sortWithinPartitions("root", "i", "j").transform(
                in_tasks, _link_blocks(threshold), "node long, links long, peer long"), "ngram-links")
        links = part if links is None else links.union(part)

    groups = components(links.select(F.col("node").alias("a"), F.col("peer").alias("b")), "ngram-groups")
    count = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("node", "rep", "size", *KEY).join(groups, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("class_id")).hint("rebalance")
    result = stored(
        named.join(least, "root").join(count, "node", "left").select(
            *KEY, "root", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-result")
    return rows.select("doc_id", "hash", *KEY), result


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, width: int = SHINGLE, levels: int = LEVELS,
                    recall: float = RECALL, leaf: int = LEAF) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    ``class_id`` is the smallest doc_id of the group of documents joined by
    links of Jaccard similarity ``threshold`` or more; ``n_links`` counts the
    other documents linked to this one, copies included.

    Takes any DataFrame with ``doc_id`` and ``text``; other columns are
    ignored. A null or empty text, or one without a word, is its own group with
    no links. A text of fewer than ``width`` words has one shingle of all its
    words. Repeated rows are copies of each other. A null doc_id takes part and
    names a group only where all its ids are null. An empty table gives no rows.
    """
    rows, result = _grouped(docs, threshold, width, levels, recall, leaf)
    return rows.join(result, KEY, "left").select(
        "doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of the classes' representatives."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    reps = members.select("rep")
    return d.join(reps, d.doc_id.eqNullSafe(reps.rep), "left_semi").select("text")


def keep_one(docs: DataFrame, *, threshold: float = THRESHOLD, width: int = SHINGLE, levels: int = LEVELS, recall: float = RECALL,
             leaf: int = LEAF) -> DataFrame:
    """``docs`` without its near duplicates: of each group the document with the smallest doc_id.

    Null ids come last; of documents under one id, which are different ones if
    their texts differ, the one whose text has the smaller hash stays. Of rows
    repeated under one id with one text one stays. A text without a word is its
    own group.
    """
    rows, result = _grouped(docs, threshold, width, levels, recall, leaf)
    text = F.col("text").cast("string")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    # A partial minimum: a group of any size sends one row a task.
    firsts = rows.join(result.select(*KEY, "root"), KEY).groupBy("root").agg(F.min(place).alias("p")).select("p.doc_id", "p.hash")
    kept = firsts.union(rows.filter("n = 0").select("doc_id", "hash")).distinct().select(
        F.col("doc_id").alias("kept_id"), F.col("hash").alias("kept_hash"))
    d = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    once = Window.partitionBy("id", "hash").orderBy(F.xxhash64("row"))
    out = d.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi").withColumn(
        "nth", F.row_number().over(once))
    return out.filter("nth = 1").select("row.*")
