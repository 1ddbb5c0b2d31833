"""Language-model scoring by deleted interpolation.

The probability of a token w after a context h mixes maximum-likelihood
estimates, with weights that depend on how often the context was seen:

    P(w | h) = l2[b] * c(h, w) / c(h) + l1[b] * c(w) / N + l0[b] / (V + 1)
    b = bucket of c(h): 0 for none, else 1 + floor(log2(c(h)))

The weights are learned by expectation-maximisation on held-out counts: each
training token in turn is deleted from the counts (c - 1 over N - 1) and scored
by what is left, so every token of the corpus is held out once. EM only needs,
per bucket, how many tokens have which ratios of the three estimates; these are
gathered in one pass as a table of quarter-octave ratios, whose size does not
depend on the corpus, and EM runs on that table.

Tokens are the blank-separated words of a text (A-Z in lower case), then one
end; the end also stands for the context of a text's first token.

Counting works on parts of about ``part_bytes`` of text. Each part sends its
distinct keys, sorted and packed, to buckets of the key space; a bucket adds up
the parts' training counts and returns to each part the totals of its keys, in
the part's own order and without the keys. No count table is ever broadcast or
collected, a key's rows never outnumber the parts, and a frequent word or pair
is one key a part. Words are keyed by 64-bit hashes and pairs by 48 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, partitions, remainder, stored
from tessera.llm._text import LOWER, NONBLANK, find_words, mix, runs_of, segment_hashes, text_chunks

END = np.uint64(0x0E4DE4DE4DE4DE4D)
PART_BYTES = 4 << 20
#: Text a task works through, part by part.
TASK_BYTES = 64 << 20
ZERO = -1 << 20
#: Ratios are kept in steps of 1/4 octave.
STEPS = 4
SENT = "bucket int, level int, part int, keys binary, counts binary"
TOTALS = "part int, level int, bucket int, counts binary, tokens long, kinds long"


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as the first one and their differences in as few bytes as the largest needs."""
    step = np.diff(keys)
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(step) else 1
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack_keys(blob: bytes) -> np.ndarray:
    width = blob[0]
    part = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    step = np.zeros((len(part), 8), dtype=np.uint8)
    step[:, :width] = part
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<u8", 1, 1), step.view("<u8")[:, 0]]), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts as bytes, those of 255 and more in 8 bytes at the end."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _unpack_counts(blob: bytes, n: int) -> np.ndarray:
    small = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    small[small == 255] = np.frombuffer(blob, "<i8", offset=n)
    return small


def _bucket_of(keys: np.ndarray, level: int, buckets: int) -> np.ndarray:
    """The bucket of each key: the key space cut into equal ranges."""
    top = keys >> np.uint64(32) if level == 1 else keys >> np.uint64(16)
    return (top * np.uint64(buckets)) >> np.uint64(32)


class _Tokens:
    """Tokens of a part's texts: keys of words and pairs, and where they occur."""

    def __init__(self, texts: pa.Array):
        hashes, sizes = [], []
        for _, offsets, data in text_chunks(texts):
            lower = LOWER[data]
            starts, ends, first = find_words(lower, offsets, NONBLANK)
            hashes.append(segment_hashes(lower, starts, ends))
            sizes.append(np.diff(first))
        words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        size = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.size = size + 1
        self.doc = np.repeat(np.arange(len(size)), self.size)
        last = np.cumsum(self.size) - 1
        token = np.empty(len(self.doc), dtype=np.uint64)
        is_word = np.ones(len(token), dtype=bool)
        is_word[last] = False
        token[is_word] = words
        token[last] = END
        self.words, self.word = np.unique(token, return_inverse=True)
        context = np.concatenate([[END], token[:-1]]).astype(np.uint64)
        pair = mix(context * np.uint64(0x9E3779B97F4A7C15) + token) >> np.uint64(16)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)

    def keys(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.words, self.word) if level == 1 else (self.pairs, self.pair)


@dataclass
class Estimates:
    """c(w), c(h), c(h, w) of every token of a part."""

    word: np.ndarray
    context: np.ndarray
    pair: np.ndarray


def _group(group: pa.Table) -> tuple[_Tokens, pa.Table, Estimates | None]:
    """A part's documents, their tokens and, where its totals came along, the counts."""
    kind = group.column("kind").to_numpy()
    docs = group.filter(pa.array(kind == 1)).combine_chunks()
    tokens = _Tokens(docs.column("text").combine_chunks() if docs.num_rows else pa.array([], pa.string()))
    totals = group.filter(pa.array(kind == 0))
    if not totals.num_rows or not docs.num_rows:
        return tokens, docs, None
    level, bucket = totals.column("level").to_numpy(), totals.column("bucket").to_numpy()
    blobs = totals.column("counts").to_pylist()
    found = []
    for k in (1, 2):
        _, where = tokens.keys(k)
        rows = np.flatnonzero(level == k)
        rows = rows[np.argsort(bucket[rows], kind="stable")]
        counts = np.concatenate([_counts_of(blobs[r]) for r in rows.tolist()])
        found.append(counts[where])
    word, pair = found
    context = np.concatenate([[word[tokens.size[0] - 1]], word[:-1]])  # an end's count is that of the starts
    return tokens, docs, Estimates(word, context, pair)


def _counts_of(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    return _unpack_counts(blob[4:], n)


def _send(buckets: int):
    """Distinct keys of each part with their training counts, by bucket."""

    def compute(batches):
        for group in runs_of(batches, ["part"]):
            part = group.column("part")[0].as_py()
            tokens, docs, _ = _group(group)
            train = docs.column("train").to_numpy()[tokens.doc]
            for level in (1, 2):
                keys, where = tokens.keys(level)
                counts = np.bincount(where, weights=train, minlength=len(keys)).astype(np.int64)
                bucket = _bucket_of(keys, level, buckets).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                ks, cs = np.split(keys, cuts), np.split(counts, cuts)
                n = len(ks)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[np.concatenate([[0], cuts])].astype(np.int32)), pa.array(np.full(n, level, np.int32)),
                    pa.array(np.full(n, part, np.int32)), pa.array([_pack_keys(k) for k in ks], pa.binary()),
                    pa.array([_pack_counts(c) for c in cs], pa.binary())],
                    names=["bucket", "level", "part", "keys", "counts"])

    return compute


def _add_up(batches):
    """Totals of a bucket's keys, returned to the parts; one row without a part sums up the bucket."""
    for group in runs_of(batches, ["bucket", "level"]):
        bucket, level = (group.column(c)[0].as_py() for c in ("bucket", "level"))
        keys = [_unpack_keys(b) for b in group.column("keys").to_pylist()]
        counts = [_unpack_counts(b, len(k)) for b, k in zip(group.column("counts").to_pylist(), keys, strict=True)]
        size = [len(k) for k in keys]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
        back = np.split(total[where], np.cumsum(size)[:-1])
        blobs = [np.array([len(b)], "<u4").tobytes() + _pack_counts(b) for b in back]
        parts = [*group.column("part").to_pylist(), None]
        n = len(parts)
        yield pa.RecordBatch.from_arrays([
            pa.array(parts, pa.int32()), pa.array([level] * n, pa.int32()), pa.array([bucket] * n, pa.int32()),
            pa.array([*blobs, None], pa.binary()), pa.array([*[None] * (n - 1), int(total.sum())], pa.int64()),
            pa.array([*[None] * (n - 1), int((total > 0).sum())], pa.int64())],
            names=["part", "level", "bucket", "counts", "tokens", "kinds"])


def _bucket_by_frequency(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.frexp(np.maximum(count, 1).astype(np.float64))[1], 0)


def _ratios(batches, n: int, v: int):
    """Per bucket, how many training tokens have which ratios once they are deleted from the counts."""
    for group in runs_of(batches, ["part"]):
        tokens, docs, c = _group(group)
        if c is None:
            continue
        train = docs.column("train").to_numpy()[tokens.doc]
        word, context, pair = (x[train] - 1 for x in (c.word, c.context, c.pair))
        if not len(word):
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            by_pair = np.log2(pair / context * (v + 1))
            by_word = np.log2(word / max(1, n - 1) * (v + 1))
        cell = np.stack([_bucket_by_frequency(context),
                         np.where(pair > 0, np.round(np.where(pair > 0, by_pair, 0) * STEPS), ZERO),
                         np.where(word > 0, np.round(np.where(word > 0, by_word, 0) * STEPS), ZERO)]).astype(np.int64)
        cells, count = np.unique(cell, axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in cells), pa.array(count)],
                                         names=["b", "pair", "word", "n"])


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = 200, floor: float = 1e-6) -> np.ndarray:
    """EM on (bucket, pair ratio, word ratio, tokens): mixture weights (pair, word, uniform) per bucket.

    A bucket without tokens takes the weights of the one below it; without any
    token all weight is on the uniform estimate.
    """
    top = max([c[0] for c in cells], default=0)
    weights = np.zeros((max(64, top + 1), 3))
    if not cells:
        weights[:, 2] = 1
        return weights
    weights[0] = (0.0, 0.5, 0.5)
    by_bucket: dict[int, list] = {}
    for b, *rest in cells:
        by_bucket.setdefault(b, []).append(rest)
    for b in range(len(weights)):
        if b:
            weights[b] = weights[b - 1]
        if b in by_bucket:
            rows = np.array(by_bucket[b], dtype=np.float64)
            ratio = np.ones((len(rows), 3))
            for k in (0, 1):
                ratio[:, k] = np.where(rows[:, k] == ZERO, 0.0, 2.0 ** (np.maximum(rows[:, k], -4000) / STEPS))
            mixed = np.array([0.4, 0.3, 0.3])
            for _ in range(rounds):
                share = ratio * mixed
                share /= share.sum(axis=1, keepdims=True)
                mixed = (share * rows[:, 2:]).sum(axis=0) / rows[:, 2].sum()
            weights[b] = mixed
    weights = np.maximum(weights, floor)
    return weights / weights.sum(axis=1, keepdims=True)


def _score(batches, n: int, v: int, weights: np.ndarray):
    for group in runs_of(batches, ["part"]):
        tokens, docs, c = _group(group)
        if c is None:
            continue
        base = np.log10((c.word + 0.5) / (n + 0.5 * (v + 1)))
        share = weights[_bucket_by_frequency(c.context)]
        p = (share[:, 0] * c.pair / np.maximum(1, c.context) + share[:, 1] * c.word / max(1, n) + share[:, 2] / (v + 1))
        m = docs.num_rows

        def total(x):
            return np.bincount(tokens.doc, weights=x, minlength=m)

        yield pa.RecordBatch.from_arrays([
            docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(),
            pa.array(tokens.size.astype(np.int64)), pa.array(total(c.word > 0).astype(np.int64)),
            pa.array(np.full(m, n, np.int64)), pa.array(total(base)), pa.array(total(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _tasks(least: int, size: int) -> int:
    """Tasks for ``size`` bytes of text: the session's number, more where it would give a task more than ``TASK_BYTES``."""
    return max(least, -(-size // TASK_BYTES))


def score(docs: DataFrame, *, folds: int = 5, held_fold: int = 1, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row (doc_id, text).

    ``score`` is the model's log10 probability of the whole text, ``base_score``
    that of single tokens with half a count added. Rows whose crc32 of the id
    as text leaves ``held_fold`` modulo ``folds`` are held out; the others are
    learned from, but for null ids, which are scored only. A null or empty text
    has its end alone. Repeated rows are learned from and scored once each.
    Other columns are ignored; an empty table gives no rows. With nothing
    learned every token has probability 1.
    """
    spark = docs.sparkSession
    rest = remainder(F.col("doc_id").cast("long"), folds)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(rest != held_fold, F.lit(False)).alias("train"),
                       F.coalesce(rest == held_fold, F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    buckets = max(48, parts // 8)
    tasks = _tasks(partitions(spark), size)
    dealt = rows.select(
        F.expr(f"cast(pmod(xxhash64(doc_id, text), {parts}) as int)").alias("part"), F.lit(1).alias("kind"),
        F.lit(0).alias("level"), F.lit(0).alias("bucket"), "doc_id", "text", "train", "held_out",
        F.lit(None).cast("binary").alias("counts"))

    def by_part(df):
        return df.repartition(tasks, "part").sortWithinPartitions("part")

    sent = by_part(dealt).transform(in_tasks, _send(buckets), SENT)
    totals = stored(sent.repartition(tasks, "bucket").sortWithinPartitions("bucket", "level").transform(
        in_tasks, _add_up, TOTALS), "lm-totals")
    learned = totals.filter("part is null and level = 1").agg(F.sum("tokens"), F.sum("kinds")).first()
    n, v = (int(x or 0) for x in learned)
    returned = totals.filter("part is not null").select(
        "part", F.lit(0).alias("kind"), "level", "bucket", F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("string").alias("text"), F.lit(False).alias("train"), F.lit(False).alias("held_out"), "counts")
    counted = by_part(dealt.union(returned))
    cells = stored(counted.transform(in_tasks, lambda it: _ratios(it, n, v), "b int, pair int, word int, n long").groupBy(
        "b", "pair", "word").agg(F.sum("n").alias("n")), "lm-ratios")
    # Cells are ratios in quarter octaves by bucket: their number is bounded whatever the corpus.
    weights = learn_weights(sorted(tuple(r) for r in cells.collect()))
    return counted.transform(
        in_tasks, lambda it: _score(it, n, v, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
