"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of a run of documents, in order, in blocks of ``BLOCK``
ids. A block stores its smallest id, and every id less that minimum in
``width`` bits, where the width is the number of bits that ``PERCENTILE`` of
the block's ids fit into. Ids that need more bits are exceptions, listed after
the packed words. An index at the head of the file gives the byte where each
block starts, so any id can be read without the blocks before it.

    file  = "PFORIDS1" | u32 block size | u32 blocks | u64 ids
            | u64 start of each block and of the end | blocks
    block = u32 minimum | u16 width | u16 exceptions
            | packed ids (u64 words) | u16 places | u32 values
All numbers are little-endian; places are padded to a multiple of 4 bytes and
the block to a multiple of 8.

The files are the ``data`` column of a table written by Spark (so any store
will do), beside the ids and lengths of their documents; documents are in
ascending order of doc_id over (part, file).
"""

from __future__ import annotations

import gc
import json
import os
import re
import string
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, partitions

BLOCK = 512
PERCENTILE = 0.9
FILE_IDS = 1 << 20
MAGIC = b"PFORIDS1"
FILES = "part int, file int, start long, doc_ids array<long>, sizes array<long>, data binary"


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of residuals below 2**width as rows of 64-bit words."""
    rows, n = rest.shape
    words = np.zeros(((n * width + 63) // 64 + 1, rows), dtype=np.uint64)
    columns = np.ascontiguousarray(rest.T).astype(np.uint64)
    for j in range(n if width else 0):
        k, s = divmod(j * width, 64)
        words[k] |= columns[j] << np.uint64(s)
        if s + width > 64:
            words[k + 1] |= columns[j] >> np.uint64(64 - s)
    return np.ascontiguousarray(words[: (n * width + 63) // 64].T)


def _unpack(words: np.ndarray, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, len(words)), dtype=np.uint64)
    columns = np.ascontiguousarray(words.T)
    mask = np.uint64((1 << width) - 1)
    for j in range(n if width else 0):
        k, s = divmod(j * width, 64)
        v = columns[k] >> np.uint64(s)
        if s + width > 64:
            v |= columns[k + 1] << np.uint64(64 - s)
        out[j] = v & mask
    return out.T.astype(np.uint32)


def encode_file(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One file of the format above."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    blocks = -(-len(ids) // block)
    head = MAGIC + np.array([block, blocks], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes()
    if not blocks:
        return head + np.zeros(1, "<u8").tobytes()
    rows = np.full(blocks * block, ids[-1], dtype=np.uint32)  # padding repeats the last id
    rows[: len(ids)] = ids
    rows = rows.reshape(blocks, block)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    nth = int(percentile * (block - 1))
    width = np.frexp(np.partition(rest, nth, axis=1)[:, nth].astype(np.float64))[1]
    bodies: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        part = rest[which]
        over = part >= 1 << w if w < 32 else np.zeros(part.shape, dtype=bool)
        row, place = np.nonzero(over)
        odd = np.bincount(row, minlength=len(which))
        heads = np.zeros((len(which), 4), "<u2")
        heads[:, :2] = low[which].astype("<u4").view("<u2").reshape(-1, 2)
        heads[:, 2], heads[:, 3] = w, odd
        front = np.concatenate([heads.view(np.uint8), _pack(np.where(over, 0, part), w).astype("<u8").view(np.uint8)], axis=1)
        front, step = front.tobytes(), front.shape[1]
        places, values = place.astype("<u2").tobytes(), part[over].astype("<u4").tobytes()
        at = 0
        for i, (b, n) in enumerate(zip(which.tolist(), odd.tolist(), strict=True)):
            body = front[i * step: (i + 1) * step]
            if n:
                body += places[2 * at: 2 * (at + n)] + b"\0" * (2 * n % 4) + values[4 * at: 4 * (at + n)]
                body += b"\0" * (-len(body) % 8)
                at += n
            bodies[b] = body
    starts = np.zeros(blocks + 1, "<u8")
    np.cumsum([len(b) for b in bodies], out=starts[1:])
    starts += len(head) + starts.nbytes
    return b"".join([head, starts.tobytes(), *bodies])


def decode_file(data: bytes) -> np.ndarray:
    """The ids of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token id file")
    block, blocks = (int(x) for x in np.frombuffer(data, "<u4", 2, 8))
    count = int(np.frombuffer(data, "<u8", 1, 16)[0])
    starts = np.frombuffer(data, "<u8", blocks + 1, 24).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    head = raw[starts[:-1, None] + np.arange(8)] if blocks else np.empty((0, 8), np.uint8)
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0] if blocks else np.empty(0, np.uint32)
    width, odd = (np.ascontiguousarray(head[:, a:a + 2]).view("<u2")[:, 0] if blocks else np.empty(0, np.uint16) for a in (4, 6))
    out = np.empty((blocks, block), dtype=np.uint32)
    for w in np.unique(width).tolist():
        which = np.flatnonzero(width == w)
        size = (block * w + 63) // 64 * 8
        words = raw[starts[which, None] + 8 + np.arange(size)]
        words = np.ascontiguousarray(words).view("<u8") if size else np.zeros((len(which), 1), np.uint64)
        part = _unpack(words, w, block)
        for i in np.flatnonzero(odd[which]).tolist():
            n, at = int(odd[which[i]]), int(starts[which[i]]) + 8 + size
            part[i, np.frombuffer(data, "<u2", n, at)] = np.frombuffer(data, "<u4", n, at + (2 * n + 3) // 4 * 4)
        out[which] = part + low[which, None]
    return out.ravel()[:count]


class Encoder:
    """Ids of texts by a tokenizer file, as the tokenizers library gives them.

    With a byte-level tokenizer no token crosses a single space between two
    visible characters, so texts are cut at spaces and each distinct piece is
    encoded once; the pieces' ids are kept between batches, up to ``kept``
    pieces, of which those met again outlast the others. Texts with other
    blanks beside a space are cut only where that is safe, and other tokenizers
    get whole texts.
    """

    #: Visible characters for any notion of blank: ASCII and the Latin letters after it.
    _VISIBLE = "!-~À-ɏ"
    _SAFE = re.compile(f"(?<=[{_VISIBLE}]) (?=[{_VISIBLE}])")
    _LATIN = re.compile("[A-Za-zÀ-ɏ]+").fullmatch
    _SEEN = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x250)]))
    _MARKS = string.punctuation
    #: Pieces that are encoded as one text.
    _JOINED = 100
    #: Pieces whose ids are Python objects at a time.
    _SLICE = 10_000

    def __init__(self, path: str, kept: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept = kept
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        self.by_piece = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space") and not spec.get("normalizer")
                         and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                     for t in spec.get("added_tokens") or []))
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab()
            self.spaced_id = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids of tokens that begin with a space
            self.spaced_id[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True
            # The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
            printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
            hidden = [x for x in range(256) if x not in set(printable)]
            self.letters = {x: 256 + i for i, x in enumerate(hidden)}
        self._forget()

    def _forget(self) -> None:
        self.spaced: dict[str, int] = {}
        self.plain: dict[str, int] = {}
        self.n = 0  # pieces; the arrays below may have room for more
        self.ids = np.empty(0, dtype=np.uint32)
        self.at = np.zeros(1, dtype=np.int64)
        self.safe = np.empty((0, 2), dtype=bool)  # of each piece, whether it begins and ends with a visible character
        self.again = np.empty(0, dtype=bool)  # of each piece, whether it was met again since it was learned or last kept

    def _trim(self) -> None:
        """Forgets the pieces not met again, or all of them where that leaves more than half of ``kept``."""
        keep, sizes = self.again[: self.n], np.diff(self.at[: self.n + 1])
        if 2 * np.count_nonzero(keep) > self.kept:
            self._forget()
            return
        new, stays = (np.cumsum(keep) - 1).tolist(), keep.tolist()
        self.spaced = {x: new[i] for x, i in self.spaced.items() if stays[i]}
        self.plain = {x: new[i] for x, i in self.plain.items() if stays[i]}
        self.ids = self.ids[: self.at[self.n]][np.repeat(keep, sizes)]
        self.at = np.concatenate([[0], np.cumsum(sizes[keep])])
        self.safe = self.safe[: self.n][keep]
        self.n = len(self.safe)
        self.again = np.zeros(self.n, dtype=bool)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _sliced(self, pieces: list, ids, slice_size: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each) of ``ids`` of pieces, a slice of them being lists at a time."""
        flat, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), slice_size):
            got = ids(pieces[i: i + slice_size])
            flat.append(self._flat(got))
            sizes.append(np.fromiter(map(len, got), dtype=np.int64, count=len(got)))
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, memo: dict[str, int], new: list[str], lead: str) -> None:
        """Ids of pieces not met before, each with ``lead`` in front."""
        collecting = gc.isenabled()
        gc.disable()  # lists of ids by the hundred thousand, none in a cycle
        try:
            self._learn_all(memo, self._learn_words(memo, new) if lead else new, lead)
        finally:
            if collecting:
                gc.enable()

    def _learn_all(self, memo: dict[str, int], new: list[str], lead: str) -> None:
        if not new:
            return
        seen = self._SEEN
        sizes, rest, ids = [], new, []
        if lead:  # pieces without blanks at their ends or inside go together: each begins with the one token with a space
            whole = [x for x in new if x[:1] in seen and x[-1:] in seen and " " not in x]
            rest = [x for x in new if not (x[:1] in seen and x[-1:] in seen and " " not in x)]
            new = whole + rest
            joined = [lead + lead.join(whole[i: i + self._JOINED]) for i in range(0, len(whole), self._JOINED)]
            flat, _ = self._sliced(joined, self._ids, self._SLICE // self._JOINED)
            starts = np.flatnonzero(self.spaced_id[flat])
            if len(starts) != len(whole):
                raise ValueError("the tokenizer joins pieces across spaces")
            ids.append(flat)
            sizes.append(np.diff(np.append(starts, len(flat))))
        flat, size = self._sliced([lead + x for x in rest], self._ids, self._SLICE)
        self._keep(memo, new, np.concatenate([*ids, flat]), np.concatenate([*sizes, size]))

    def _learn_words(self, memo: dict[str, int], new: list[str]) -> list[str]:
        """Learns the pieces that are Latin letters with or without marks behind them; returns the others.

        Such a piece is two pre-tokens, the spaced word and the marks, so the
        model's ids of the word serve all its punctuations.
        """
        words, others = [], []
        for x in new:
            w = x.rstrip(self._MARKS)
            if w.isalpha() and (w.isascii() or self._LATIN(w)):
                words.append((x, w))
            else:
                others.append(x)
        unknown = [w for w in dict.fromkeys(w for _, w in words) if w not in memo]
        tokenize = self.tokenizer.model.tokenize

        def word_ids(words: list[str]) -> list[list[int]]:
            return [[t.id for t in tokenize("\u0120" + (w if w.isascii() else w.encode().decode("latin-1").translate(self.letters)))]
                    for w in words]

        self._keep(memo, unknown, *self._sliced(unknown, word_ids, self._SLICE), visible=True)
        marked = [(x, memo[w], x[len(w):]) for x, w in words if len(x) > len(w)]
        if marked:
            marks = {m: i for i, m in enumerate(dict.fromkeys(m for _, _, m in marked))}
            behind, size = self._sliced(list(marks), self._ids, self._SLICE)
            word = np.fromiter((i for _, i, _ in marked), dtype=np.int64, count=len(marked))
            mark = np.fromiter((marks[m] for _, _, m in marked), dtype=np.int64, count=len(marked))
            first, n_word, n_mark = self.at[word], self.at[word + 1] - self.at[word], size[mark]
            sizes = n_word + n_mark
            ends = np.cumsum(sizes)
            ids = np.empty(ends[-1], dtype=np.uint32)
            ids[self._ranges(ends - sizes, n_word)] = self.ids[self._ranges(first, n_word)]
            ids[self._ranges(ends - n_mark, n_mark)] = behind[self._ranges((np.cumsum(size) - size)[mark], n_mark)]
            self._keep(memo, [x for x, _, _ in marked], ids, sizes, visible=True)
        return others

    def _keep(self, memo: dict[str, int], pieces: list[str], ids: np.ndarray, sizes: np.ndarray, visible: bool = False) -> None:
        n, n_ids, seen = self.n, self.at[self.n], self._SEEN
        memo.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.ids = self._grown(self.ids, n_ids, ids)
        self.at = self._grown(self.at, n + 1, n_ids + np.cumsum(sizes))
        safe = np.ones((len(pieces), 2), dtype=bool)
        if not visible:
            safe[:] = np.array([(x[:1] in seen, x[-1:] in seen) for x in pieces], dtype=bool).reshape(-1, 2)
        self.safe = self._grown(self.safe, n, safe)
        self.again = self._grown(self.again, n, np.zeros(len(pieces), dtype=bool))
        self.n = n + len(pieces)

    @staticmethod
    def _grown(rows: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
        """The first ``n`` rows with ``more`` behind them, in place while there is room."""
        end = n + len(more)
        if end > len(rows):
            rows, old = np.empty((max(end, n + n // 2), *rows.shape[1:]), dtype=rows.dtype), rows
            rows[:n] = old[:n]
        rows[n:end] = more
        return rows

    @staticmethod
    def _flat(lists: list[list[int]]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=sum(map(len, lists)))

    def _places(self, memo: dict[str, int], pieces: list[str], lead: str) -> np.ndarray:
        place = np.fromiter(map(memo.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        self.again[place[place >= 0]] = True
        missing = np.flatnonzero(place < 0).tolist()
        if missing:
            unknown = [pieces[i] for i in missing]
            self._learn(memo, list(dict.fromkeys(unknown)), lead)
            place[missing] = np.fromiter(map(memo.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        return place

    @staticmethod
    def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The indices start, start + 1, ... of each range, one range after the other."""
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(n, int((start + size).max(initial=0))) < 1 << 31 else np.int64
        index = np.repeat((start - (ends - size)).astype(kind), size)
        index += np.arange(n, dtype=kind)
        return index

    def _gather(self, place: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces at ``place``, and their number per text; texts begin at ``first`` (and end)."""
        start = self.at[place]
        size = self.at[place + 1] - start
        total = np.zeros(len(place) + 1, dtype=np.int64)
        np.cumsum(size, out=total[1:])
        return self.ids[self._ranges(start, size)], np.diff(total[first])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); no text may be null."""
        if not self.by_piece:
            got = self._ids(texts.to_pylist())
            return self._flat(got), np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if self.n > self.kept:
            self._trim()
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        distinct, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        place = self._places(self.spaced, distinct, " ")[code]
        first, last = at[:-1], at[1:] - 1
        begins, ends = self.safe[place, 0], self.safe[place, 1]
        begins[first] = True
        ends[last] = True
        odd = np.flatnonzero(np.add.reduceat(~(begins & ends), first))
        place[first] = self._places(self.plain, [distinct[c] for c in code[first].tolist()], "")
        ids, sizes = self._gather(place, at)
        if not len(odd):
            return ids, sizes
        # Texts with a blank beside a space: cut at the other spaces.
        cut = [self._SAFE.split(texts[i].as_py()) for i in odd.tolist()]
        bounds = np.cumsum([0, *map(len, cut)])
        place = self._places(self.spaced, [p for c in cut for p in c], " ")
        place[bounds[:-1]] = self._places(self.plain, [c[0] for c in cut], "")
        odd_ids, odd_sizes = self._gather(place, bounds)
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for i, part in zip(odd.tolist(), np.split(odd_ids, np.cumsum(odd_sizes)[:-1]), strict=True):
            parts[i] = part
        sizes[odd] = odd_sizes
        return np.concatenate(parts), sizes


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(docs: DataFrame, tokenizer: str, path: str, *, end_id: int | None = 2, parts: int | None = None,
          file_ids: int = FILE_IDS, chunk_bytes: int = 1 << 21) -> None:
    """Writes the ids of every whole text of ``docs`` (doc_id, text) as files under ``path``.

    ``tokenizer`` is the path of a tokenizers file that every executor has.
    Documents go in ascending doc_id order, null ids first and rows with one id
    by a hash of their text; a null text is empty and has the end id alone
    (``end_id`` None appends none). A file is closed at ``file_ids`` ids and
    never splits a document. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts or partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h").select(
        F.spark_partition_id().alias("part"), "doc_id", "text")
    tail = [] if end_id is None else [end_id]

    def compute(batches):
        encode = _encoder(tokenizer)
        held_ids, held_docs, held_sizes = [], [], []
        file = done = held = 0
        part = None

        def flush():
            nonlocal file, done, held
            sizes = np.concatenate(held_sizes)
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": pa.array([file], pa.int32()), "start": pa.array([done]),
                "doc_ids": pa.array([[d for ds in held_docs for d in ds]], pa.list_(pa.int64())),
                "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
                "data": pa.array([encode_file(np.concatenate(held_ids))], pa.binary())})
            file, done, held = file + 1, done + held, 0
            held_ids.clear(), held_docs.clear(), held_sizes.clear()
            return out

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            bytes_before = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(bytes_before, bytes_before[lo] + chunk_bytes, "right")) - 1)
                ids, sizes = encode(texts[lo:hi])
                if tail:
                    ids = np.insert(ids, np.cumsum(sizes), end_id)
                    sizes = sizes + 1
                ends = np.cumsum(sizes)
                a = 0
                while a < hi - lo:
                    before = int(ends[a - 1]) if a else 0
                    b = min(hi - lo, int(np.searchsorted(ends, before + file_ids - held)) + 1)
                    held_ids.append(ids[before: int(ends[b - 1])])
                    held_docs.append(doc_ids[lo + a: lo + b])
                    held_sizes.append(sizes[a:b])
                    held += int(ends[b - 1]) - before
                    if held >= file_ids:
                        yield flush()
                    a = b
                lo = hi
        if held_docs:
            yield flush()

    dealt.transform(in_tasks, compute, FILES).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document in the files under ``path``; start counts all ids before it."""
    files = spark.read.schema(FILES).parquet(path)

    def compute(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode_file(batch.column("data")[i].as_py())
                sizes = np.array(batch.column("sizes")[i].as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                at = np.concatenate([[0], ends]).astype(np.int32)
                start = batch.column("base")[i].as_py() + batch.column("start")[i].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()), pa.array(start), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int64)))],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return _with_base(files).transform(in_tasks, compute, "doc_id long, start long, n_tokens long, ids array<long>")


def _with_base(files: DataFrame) -> DataFrame:
    """The files with the number of ids in the parts before theirs (one row a part is summed up and broadcast)."""
    totals = files.groupBy("part").agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return files.join(F.broadcast(totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))), "part")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded files."""
    files = spark.read.schema(FILES).parquet(path)

    def compute(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode_file(batch.column("data")[i].as_py()).astype("<u4")
                sizes = np.array(batch.column("sizes")[i].as_py(), dtype=np.int64)
                ends = np.cumsum(sizes)
                start = batch.column("base")[i].as_py() + batch.column("start")[i].as_py() + ends - sizes
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()), pa.array(start), pa.array(sizes),
                     pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _with_base(files).transform(in_tasks, compute, "doc_id long, start long, n_tokens long, ids_crc32 long")
