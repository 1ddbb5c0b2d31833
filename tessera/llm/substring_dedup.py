"""Substring deduplication by sliding sentence spans, and word windows for what no span can hold.

Every run of several consecutive sentences is hashed by its words (ASCII letters
in lower case; punctuation and blanks do not count). Runs are joined globally by
hash; a run's first occurrence is the one in the smallest doc_id and, in it, the
earliest. Sentences covered by any other occurrence are removed.

A run is the shortest one from its first sentence on, or up to its last
sentence, that has at least ``sentences`` sentences and ``words`` words; taking
both makes every sentence of a repeated passage part of a run inside it.
Sentences end after ``.``, ``!``, ``?`` before a blank, at an ideographic full
stop, and at line ends; one of more than ``LONG`` words is cut after words
picked by their hash.

Runs miss a passage under other stops or line ends, and its ends inside longer
sentences. So windows of ``words`` consecutive words are joined in the same way
besides, wherever they begin and end, and words covered by any but the first
occurrence go too, with what follows them up to the next word. The hashes of
windows that stand only once are never written: the anchor of a window is the
smallest hash of its ``GRAM``-word grams, equal windows have equal anchors, and
neighbours mostly share one. Anchors are joined together with the runs; only
windows whose anchor is in more than one document are hashed and joined
themselves. All steps are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm._spark import in_tasks, stored
from tessera.llm._text import ALNUM, LOWER, NONBLANK, find_words, fold_hashes, mix, segment_hashes, text_chunks

SENTENCES = 2
WORDS = 20
GRAM = 8
LONG = 24
LAST = (1 << 63) - 1


class _Units:
    """Sentences, their runs, words and windows of a run of texts, with their byte ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sentences: int, words: int):
        lower = LOWER[data]
        starts, ends, first = find_words(lower, offsets, ALNUM)
        hashes = segment_hashes(lower, starts, ends)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        blank = np.ones(len(data) + 1, dtype=bool)
        blank[:-1] = ~NONBLANK[data]
        stop = (data == 46) | (data == 33) | (data == 63)
        stop &= blank[1:]
        stop |= data == 10
        if len(data) > 2:
            stop[2:] |= (data[2:] == 0x82) & (data[1:-1] == 0x80) & (data[:-2] == 0xE3)
        sentence = np.cumsum(stop)[starts] if len(starts) else np.empty(0, np.int64)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (sentence[1:] != sentence[:-1]) | (doc[1:] != doc[:-1])
        number = np.cumsum(new) - 1
        long = np.bincount(number)[number] > LONG if len(starts) else new
        new[1:] |= long[1:] & (hashes[:-1] & np.uint64(7) == 0)
        self.unit = np.cumsum(new) - 1  # of each word
        self.doc = doc[new]  # of each unit
        self.start = starts
        self.end = np.append(starts[1:], len(data))[:len(starts)]
        last = np.ones(len(starts), dtype=bool)
        last[:-1] = doc[1:] != doc[:-1]
        self.end[last] = offsets[doc[last] + 1]
        self._spans(hashes, np.append(np.flatnonzero(new), len(starts)), len(offsets) - 1, sentences, words)
        at = np.arange(max(0, len(starts) - words + 1))
        self.at = at = at[doc[at] == doc[at + words - 1]]  # each window's first word
        self.run = fold_hashes(hashes, at, at + words)
        self.run_doc = doc[at]
        gram = min(GRAM, words)
        at = np.arange(max(0, len(starts) - gram + 1))
        self.anchor = _least(fold_hashes(hashes, at, at + gram), words - gram + 1)[self.at]


    def _spans(self, hashes: np.ndarray, bounds: np.ndarray, docs: int, sentences: int, words: int) -> None:
        """The runs of sentences: first word, last word + 1, hash, document; ``bounds`` are the sentences' first words."""
        n = len(bounds) - 1
        first = np.searchsorted(self.doc, np.arange(docs + 1))
        left, right = first[self.doc], first[self.doc + 1]
        at = np.arange(n)
        to = np.maximum(np.searchsorted(bounds, bounds[:-1] + words), at + sentences)
        back = np.minimum(np.searchsorted(bounds, bounds[1:] - words, "right") - 1, at + 1 - sentences)
        forward, backward = to <= right, back >= left
        a = np.concatenate([at[forward], back[backward]])
        b = np.concatenate([to[forward], at[backward] + 1])
        _, pick = np.unique(a * (n + 1) + b, return_index=True)  # by place
        a, b = a[pick], b[pick]
        unit = fold_hashes(hashes, bounds[:-1], bounds[1:])
        self.span = mix(fold_hashes(unit, a, b))  # mixed once more: never taken for a window or anchor of the same words
        self.span_doc = self.doc[a]
        self.span_from, self.span_to = bounds[a], bounds[b]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values, span = np.minimum(values[:-span], values[span:]), span * 2
    return np.minimum(values[: max(0, len(values) - (width - span))], values[width - span:])


def _sources(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), F.col("text").cast("string"))


def _in(doc: np.ndarray, run: np.ndarray) -> np.ndarray:
    """One hash of (document of the chunk, hash)."""
    return run ^ mix(doc.astype(np.uint64) + np.uint64(1))


def _emit(keys: np.ndarray, doc: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    """(run, key), once a document."""
    _, pick = np.unique(_in(doc, run), return_index=True)
    return pa.RecordBatch.from_arrays([pa.array(run[pick].view(np.int64)), pa.array(keys[doc[pick]])], names=["run", "key"])


class _Lists:
    """A column of lists of hashes, read by runs of rows."""

    def __init__(self, column: pa.Array):
        self.values = column.flatten().to_numpy().view(np.uint64)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        self.at = np.append(0, np.cumsum(sizes, dtype=np.int64))

    def member(self, row: int, n: int, doc: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Whether each run is in the list of its document, the documents being the ``n`` rows from ``row`` on."""
        at = self.at[row: row + n + 1]
        return np.isin(_in(doc, run), _in(np.repeat(np.arange(n), np.diff(at)), self.values[at[0]: at[-1]]))


def runs_and_anchors(docs: DataFrame, *, sentences: int = SENTENCES, words: int = WORDS, windows: bool = True) -> DataFrame:
    """(run, key, span): the hash of every run of sentences (``span``) and the windows' anchors, once a document."""

    def compute(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for row, offsets, data in text_chunks(batch.column("text")):
                u = _Units(data, offsets, sentences, words)
                for doc, run, span in ((u.span_doc, u.span, True), *([(u.run_doc, u.anchor, False)] if windows else [])):
                    found = _emit(keys[row:], doc, run)
                    yield found.append_column("span", pa.array(np.full(found.num_rows, span)))

    return _sources(docs).transform(in_tasks, compute, "run long, key long, span boolean")


def _repeated(runs: DataFrame) -> DataFrame:
    """``runs`` that are in several documents, and the ``first`` of these."""
    first = runs.groupBy("run").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("run").alias("repeated"), "first").hint("rebalance")
    return runs.join(first, F.expr("run = repeated")).drop("repeated")


def _windows(docs: DataFrame, shared: DataFrame, sentences: int, words: int) -> DataFrame:
    """(run, key): the hash of every window whose anchor is among its document's ``shared`` ones, once a document."""
    lists = shared.groupBy("key").agg(F.collect_set("run").alias("anchors"))  # at most the anchors of one document

    def compute(batches):
        for batch in batches:
            keys, wanted = batch.column("key").to_numpy(), _Lists(batch.column("anchors"))
            for row, offsets, data in text_chunks(batch.column("text")):
                u = _Units(data, offsets, sentences, words)
                hit = wanted.member(row, len(offsets) - 1, u.run_doc, u.anchor)
                yield _emit(keys[row:], u.run_doc[hit], u.run[hit])

    return _sources(docs).join(lists, "key").select("key", "text", "anchors").transform(in_tasks, compute, "run long, key long")


def _repeats_inside(doc: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Occurrences of a run of the same document after the first; runs come in order of their places."""
    again = np.ones(len(run), dtype=bool)
    again[np.unique(_in(doc, run), return_index=True)[1]] = False
    return again


def remove_repeats(docs: DataFrame, *, sentences: int = SENTENCES, words: int = WORDS, windows: bool = True) -> DataFrame:
    """doc_id, n_sentences, n_removed, words_removed, text of every row of ``docs`` (doc_id, text).

    ``text`` is the text without the removed sentences and words; nothing else of
    it changes. ``windows=False`` removes whole sentences of repeated runs only.
    ``n_removed`` counts the sentences of which no word is left. Null and empty
    texts come back as they are, with zeros. Rows with
    one doc_id are one document: what they share is not removed across them
    (a repeat inside one row is). Null ids come last and are one document.
    Other columns are ignored; an empty table gives no rows.
    """
    pieces = stored(runs_and_anchors(docs, sentences=sentences, words=words, windows=windows), "sentence-runs")
    shared = stored(_repeated(pieces), "repeated-runs")
    again = shared.filter("span and key > first").select("key", "run")
    if windows:
        whole = stored(_windows(docs, shared.filter("not span"), sentences, words), "windows")
        again = again.unionAll(stored(_repeated(whole).filter("key > first").select("key", "run"), "later-windows"))
    later = again.groupBy("key").agg(F.collect_set("run").alias("later"))  # at most the runs and windows of one document
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "place", F.coalesce("doc_id", F.lit(LAST)))

    def compute(batches):
        for batch in batches:
            later = _Lists(batch.column("later"))
            texts, counts = [], []
            for row, offsets, data in text_chunks(batch.column("text")):
                n = len(offsets) - 1
                u = _Units(data, offsets, sentences, words)
                cover = np.zeros(len(u.start) + 1, dtype=np.int64)
                hit = _repeats_inside(u.span_doc, u.span) | later.member(row, n, u.span_doc, u.span)
                np.add.at(cover, u.span_from[hit], 1)
                np.add.at(cover, u.span_to[hit], -1)
                if windows:
                    hit = _repeats_inside(u.run_doc, u.run) | later.member(row, n, u.run_doc, u.run)
                    cover[u.at[hit]] += 1
                    cover[u.at[hit] + words] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                whole = np.bincount(u.unit, weights=~gone, minlength=len(u.doc)) == 0
                edge = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(edge, u.start[gone], 1)
                np.add.at(edge, u.end[gone], -1)
                keep = np.cumsum(edge[:-1]) == 0
                kept = np.zeros(len(data) + 1, dtype=np.int64)
                np.cumsum(keep, out=kept[1:])
                texts.append((kept[offsets], data[keep]))
                counts.append(np.stack([
                    np.bincount(u.doc, minlength=n), np.bincount(u.doc, weights=whole, minlength=n),
                    np.bincount(u.doc[u.unit], weights=gone, minlength=n)]).astype(np.int64))
            if not texts:
                continue
            total = np.concatenate(counts, axis=1)
            text = pa.concat_arrays([pa.LargeStringArray.from_buffers(
                len(o) - 1, pa.py_buffer(o), pa.py_buffer(np.ascontiguousarray(b))) for o, b in texts])
            text = pc.if_else(batch.column("text").is_null(), pa.scalar(None, pa.large_string()), text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x) for x in total), text.cast(pa.string())],
                names=["doc_id", "n_sentences", "n_removed", "words_removed", "text"])

    schema = StructType([StructField(c, LongType()) for c in ("doc_id", "n_sentences", "n_removed", "words_removed")]
                        + [StructField("text", StringType())])
    return d.join(later, F.col("place") == F.col("key"), "left").select("doc_id", "text", "later").transform(in_tasks, compute, schema)
