"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted over all texts. Two words are near if one insertion, deletion
or replacement of a letter turns one into the other. Each word generates its
edits: every deletion, and every replacement of a letter by a smaller one, so
that each near pair comes up once, from one side (an insertion is the other
side's deletion). An edit is hashed from the word's hash without building it and
probed against blocked Bloom filters of the whole vocabulary, sharded by length:
a filter block is eight 64-bit words, a key sets one bit in each. Only edits
that every bit admits are built, shuffled and joined with the vocabulary, which
takes out the filters' false positives; so the result is exact.

Filters are built by shard in tasks, at ``BITS`` bits a word, and broadcast in
rounds of at most ``ROUND_BYTES``; a vocabulary of any size takes as many rounds
as it fills. Lengths of ``LENGTHS`` and more share a filter, so there are at most
so many sizes to know.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, partitions, stored
from tessera.llm._text import LOWER, find_words, mix, runs_of, text_chunks, _power_tables

#: The letters of words as Latin-1 code points.
LETTERS = np.concatenate([np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)]).astype(np.uint8)
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: An occurrence whose checksum this divides loses a letter.
NOISE = 199
BITS = 16
BLOCK_WORDS = 8
SHARD_WORDS = 1 << 18
LENGTHS = 256
ROUND_BYTES = 32 << 20
#: Letters of the words whose edits are probed side by side; tokens counted together.
PROBED = 1 << 15
COUNTED = 1 << 21

_ONE = np.uint64(1)
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_LONG = np.uint64(0x9E3779B97F4A7C15)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of each byte range of ``data``, continued from ``seeds``."""
    size = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    long = np.flatnonzero(size > 64)
    for i in long.tolist():
        out[i] = zlib.crc32(data[starts[i]: ends[i]], int(seeds[i]))
    by = np.argsort(-size, kind="stable")[len(long):]
    at, state = starts[by], ~seeds[by]
    more = np.searchsorted(-size[by], -np.arange(65), "left")  # words longer than p
    for p in range(64):
        m = more[p]
        if not m:
            break
        state[:m] = _CRC[(state[:m] ^ data[at[:m] + p]) & 0xFF] ^ (state[:m] >> 8)
    out[by] = ~state
    return out


class _Runs:
    """The letter runs of a chunk of texts: lower-cased bytes, ranges, lengths in letters, documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_length: int):
        lower = LOWER[data]
        head = lower == 0xC3  # of U+00C0 to U+00FF, the only letters beyond ASCII
        inside = (lower >= 0x61) & (lower <= 0x7A) | head
        inside[1:] |= head[:-1]
        starts, ends, first = find_words(inside.view(np.uint8), offsets, np.array([False, True]))
        heads = np.append(0, np.cumsum(head))
        letters = ends - starts - (heads[ends] - heads[starts])
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        keep = letters >= min_length
        self.data, self.starts, self.ends, self.letters, self.doc = lower, starts[keep], ends[keep], letters[keep], doc[keep]

    def words(self, which: np.ndarray) -> pa.Array:
        starts, size = self.starts[which], (self.ends - self.starts)[which]
        at = np.append(0, np.cumsum(size))
        data = self.data[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def _one_less(run: str, h: int) -> str:
    at = h % len(run)
    return run[:at] + run[at + 1:]


def occurrences(docs: DataFrame, *, min_length: int = MIN_LENGTH, noise: int = NOISE) -> DataFrame:
    """(word, n): counts of the words of ``docs`` (doc_id, text), summed up within tasks only."""

    def compute(batches):
        held, size = [], 0

        def counted():
            c = pc.value_counts(pa.concat_arrays(held))
            return pa.RecordBatch.from_arrays([c.field("values").cast(pa.string()), c.field("counts")], names=["word", "n"])

        for batch in batches:
            ids = ["" if d is None else str(d) for d in batch.column("doc_id").to_pylist()]
            for row, offsets, data in text_chunks(batch.column("text")):
                r = _Runs(data, offsets, min_length)
                seeds = np.array([zlib.crc32(f"{d}:".encode()) for d in ids[row: row + len(offsets) - 1]], dtype=np.uint32)
                h = checksums(r.data, r.starts, r.ends, seeds[r.doc])
                changed = h % noise == 0
                held.append(r.words(~changed))
                less = [_one_less(w, c) for w, c in zip(r.words(changed).to_pylist(), h[changed].tolist(), strict=True)]
                held.append(pa.array([w for w in less if len(w) >= min_length], pa.large_string()))
                size += len(r.starts)
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(
        in_tasks, compute, "word string, n long")


class _Words:
    """Words of a batch as Latin-1 code points, one byte a letter, with what hashing their edits takes."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.code = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        self.first = np.append(0, np.cumsum(self.size))
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.at = np.arange(len(self.code)) - self.first[self.word]
        self.up, self.down = _power_tables(int(self.size.max(initial=0)) + 1)
        self.term = _CODE[self.code] * self.up[self.at]
        sums = np.zeros(len(self.code) + 1, dtype=np.uint64)
        np.cumsum(self.term, out=sums[1:])
        self.before = sums[:-1] - sums[self.first[self.word]]  # of the letters before each, within its word
        self.sum = sums[self.first[1:]] - sums[self.first[:-1]]

    def hashes(self) -> np.ndarray:
        return _finish(self.sum, self.size)

    def deletions(self, min_length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the words without the letter at each place; of equal neighbours the first."""
        new = np.ones(len(self.code), dtype=bool)
        new[1:] = (self.code[1:] != self.code[:-1]) | (self.at[1:] == 0)
        p = np.flatnonzero(new & (self.size[self.word] > min_length))
        rest = self.sum[self.word[p]] - self.before[p] - self.term[p]
        return p, _finish(self.before[p] + rest * self.down[1], self.size[self.word[p]] - 1)

    def replacements(self, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the words with ``letter`` in each place that holds a larger one."""
        p = np.flatnonzero(self.code > letter)
        return p, _finish(self.sum[self.word[p]] - self.term[p] + _CODE[letter] * self.up[self.at[p]], self.size[self.word[p]])

    def edited(self, place: int, letter: str) -> str:
        w, at = self.words[self.word[place]], self.at[place]
        return w[:at] + letter + w[at + 1:]


def _finish(total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(total + size.astype(np.uint64) * _LONG)


class Plan:
    """Where the filters' blocks lie: shards of each length after one another, lengths ascending."""

    def __init__(self, counts: dict[int, int]):
        self.shards, self.blocks, self.start = (np.zeros(LENGTHS + 1, dtype=np.uint64) for _ in range(3))
        end, shard_ends = 0, []
        for size, n in sorted(counts.items()):
            shards = -(-n // SHARD_WORDS)
            blocks = max(4, -(-n * BITS // (64 * BLOCK_WORDS * shards)))
            self.shards[size], self.blocks[size], self.start[size] = shards, blocks, end
            shard_ends += range(end + blocks, end + shards * blocks + 1, blocks)
            end += shards * blocks
        self.rounds, first = [], 0
        room = ROUND_BYTES // (8 * BLOCK_WORDS)
        for this, after in zip(shard_ends, [*shard_ends, None][1:], strict=True):
            if after is None or after - first > room:
                self.rounds.append((first, this))
                first = this

    def block(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, block, known) of hashes of words of ``size`` letters; not known where no word is so long."""
        c = np.minimum(size, LENGTHS)
        shards, blocks = self.shards[c], self.blocks[c]
        shard = (h >> np.uint64(40)) % np.maximum(shards, _ONE)
        block = ((h & np.uint64(0xFFFFFFFF)) * blocks) >> np.uint64(32)
        return shard, self.start[c] + shard * blocks + block, shards > 0


def _bits(h: np.ndarray):
    """The bit of each word of a block that a key sets."""
    h = mix(h + _LONG)
    return [_ONE << ((h >> np.uint64(6 * j)) & np.uint64(63)) for j in range(BLOCK_WORDS)]


def filters(words: DataFrame, plan: Plan) -> DataFrame:
    """(at, bits): each filter shard's first block and its blocks, built from (word, length)."""

    def place(batches):
        for batch in batches:
            w = _Words(batch.column("word").to_pylist())
            h = w.hashes()
            shard, block, _ = plan.block(h, w.size)
            c = np.minimum(w.size, LENGTHS)
            yield pa.RecordBatch.from_arrays(
                [pa.array((plan.start[c] + shard * plan.blocks[c]).astype(np.int64)), pa.array(block.astype(np.int64)),
                 pa.array(plan.blocks[c].astype(np.int64)), pa.array(h.view(np.int64))], names=["at", "block", "blocks", "h"])

    def build(batches):
        for shard in runs_of(batches, ["at"]):
            first, blocks = shard.column("at")[0].as_py(), shard.column("blocks")[0].as_py()
            bits = np.zeros((blocks, BLOCK_WORDS), dtype=np.uint64)
            block, h = shard.column("block").to_numpy() - first, shard.column("h").to_numpy().view(np.uint64)
            for j, bit in enumerate(_bits(h)):
                np.bitwise_or.at(bits[:, j], block, bit)
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([bits.tobytes()], pa.binary())], names=["at", "bits"])

    keyed = words.select("word").transform(in_tasks, place, "at long, block long, blocks long, h long")
    return keyed.repartition(partitions(words.sparkSession), "at").sortWithinPartitions("at").transform(
        in_tasks, build, "at long, bits binary")


def _admitted(plan: Plan, first: int, bits: np.ndarray, h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which hashes the loaded blocks (those from ``first`` on) admit."""
    _, block, known = plan.block(h, size)
    rows = np.flatnonzero(known & (block >= np.uint64(first)) & (block < np.uint64(first + len(bits))))
    block, wanted = (block[rows] - np.uint64(first)).astype(np.int64), _bits(h[rows])
    left = np.arange(len(rows))
    for j, bit in enumerate(wanted):
        left = left[bits[block[left], j] & bit[left] != 0]
    return rows[left]


def candidates(words: DataFrame, plan: Plan, built: DataFrame, min_length: int) -> DataFrame:
    """(edit, word, n): the edits of every word that the filters admit, false positives among them."""
    spark = words.sparkSession
    found = None
    for first, last in plan.rounds:
        loaded = b"".join(bytes(r["bits"]) for r in sorted(built.filter(F.col("at").between(first, last - 1)).collect()))
        shared = spark.sparkContext.broadcast(loaded)

        def probe(batches, first=first, shared=shared):
            bits = np.frombuffer(shared.value, dtype=np.uint64).reshape(-1, BLOCK_WORDS)
            for batch in batches:
                names, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                size = np.append(0, np.cumsum([len(w) for w in names]))
                i = 0
                while i < len(names):
                    j = max(i + 1, int(np.searchsorted(size, size[i] + PROBED, "right")) - 1)
                    w = _Words(names[i:j])
                    p, h = w.deletions(min_length)
                    p = p[_admitted(plan, first, bits, h, w.size[w.word[p]] - 1)]
                    edits, of = [w.edited(x, "") for x in p.tolist()], [w.word[p]]
                    for letter in LETTERS.tolist():
                        p, h = w.replacements(letter)
                        p = p[_admitted(plan, first, bits, h, w.size[w.word[p]])]
                        edits += [w.edited(x, chr(letter)) for x in p.tolist()]
                        of.append(w.word[p])
                    of = np.concatenate(of)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(edits, pa.string()), pa.array([w.words[x] for x in of.tolist()], pa.string()), pa.array(n[i:j][of])],
                        names=["edit", "word", "n"])
                    i = j

        part = words.select("word", "n").transform(in_tasks, probe, "edit string, word string, n long")
        found = part if found is None else found.unionAll(part)
    return found


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) from (word, form) by following forms to the last, in paths of at most ``steps``, by doubling."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        now = stored(now, "spelling-roots")
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = now.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             noise: int = NOISE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower
    case, of at least ``min_length`` letters and ``min_count`` occurrences; an
    occurrence whose crc32 of ``<doc_id>:<run>`` is divisible by ``noise`` loses
    the letter at that checksum modulo its length. ``n`` counts occurrences,
    ``n_near`` the near words. ``form`` is the near word that occurs most (ties:
    the smallest) if it occurs at least ``ratio`` times as often, else null, and
    ``root`` the last form on the way. Null and empty texts have no words; a null
    id is an empty string in the checksum; repeated rows count each. Words of any
    length are whole. Other columns are ignored; an empty table gives no rows.
    """
    if ratio < 2 or min_length < 2:
        raise ValueError("ratio and min_length must be 2 at least")
    words = stored(occurrences(docs, min_length=min_length, noise=noise).groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= min_count), "spelling-words")
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LENGTHS)).alias("size")).agg(F.count("*"), F.max("n")).collect()
    plan = Plan({r[0]: r[1] for r in sizes})
    top = max((r[2] for r in sizes), default=min_count)
    empty = docs.sparkSession.createDataFrame([], "edit string, word string, n long")
    found = candidates(words, plan, stored(filters(words, plan), "spelling-filters"), min_length) if plan.rounds else empty
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found.join(known, F.col("edit") == F.col("near"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("word").alias("a"), F.col("near").alias("b"), F.col("near_n").alias("m")),
        F.struct(F.col("near").alias("a"), F.col("word").alias("b"), F.col("n").alias("m")))).alias("e")).select("e.*")
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best"))
    takes = -F.col("best.m") >= F.col("n") * ratio
    base = stored(words.join(best, F.col("word") == F.col("a"), "left").select(
        "word", F.when(takes, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, -F.col("best.m")).alias("form_n")), "spelling-forms")
    # Counts grow by the ratio with every form, which bounds the way.
    ends = roots(base.filter("form is not null"), int(math.log(max(1, top // min_count), ratio)) + 1)
    ends = ends.select(F.col("word").alias("from"), F.col("root").alias("end"))
    return base.join(ends, F.col("word") == F.col("from"), "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
