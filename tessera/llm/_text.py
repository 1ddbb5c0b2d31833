"""Byte-level text work on Arrow batches, shared by the Python-side operators.

Texts are handled as UTF-8 bytes in numpy arrays, a bounded chunk of documents
at a time: finding words, hashing them and combining hashes are whole-array
operations, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words made of ASCII letters, digits and everything outside ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = True
ALNUM[128:] = True
#: Bytes of words between blanks (space and 0x09 to 0x0D).
NONBLANK = np.ones(256, dtype=bool)
NONBLANK[9:14] = NONBLANK[32] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES) + 1
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range of ``data``; starts ascend and ranges do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _power_tables(hi - lo)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of runs of rows holding about ``max_bytes`` each.

    Null texts are empty. Offsets are relative to the run's bytes; a text longer
    than the limit is a run of its own.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1))
        yield i, offsets[i: j + 1] - offsets[i], data[offsets[i]: offsets[j]]
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the maximal runs of ``kind`` bytes, none across documents.

    Words of document d are first[d] to first[d + 1].
    """
    inside = kind[data]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    new = inside.copy()
    new[1:] &= ~inside[:-1]
    new[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(new)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Per document the ascending distinct hashes of its ``width``-word shingles.

    A document of fewer words, but not none, has one shingle of all its words.
    """
    n = len(hashes)
    salt = mix(np.arange(101, 101 + width, dtype=np.uint64))
    rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled += mix(hashes[k: n - width + 1 + k] + salt[k]) if n >= width else np.uint64(0)
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a: b - width + 1]))
        elif b > a:
            out.append(mix(np.array([mix(hashes[a:b] + salt[: b - a]).sum(dtype=np.uint64)], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def pieces(blobs) -> pa.Array:
    """Numpy arrays as an Arrow array of byte strings."""
    return pa.array([x.tobytes() for x in blobs], type=pa.binary())


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal ``keys`` in batches already sorted by them, one table each.

    A group may span batches; only the group being read is held.
    """
    held: list[pa.RecordBatch] = []

    def key_of(batch, row):
        return tuple(batch.column(k)[row].as_py() for k in keys)

    open_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(new), [batch.num_rows]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == 0 and held and key_of(batch, 0) != open_key:
                yield pa.Table.from_batches(held)
                held = []
            elif a > 0:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        open_key = key_of(batch, batch.num_rows - 1)
    if held:
        yield pa.Table.from_batches(held)


def fold_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of a sequence of 64-bit values; ranges may overlap."""
    up, down = _power_tables(len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix(values) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
