"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text answers "how long is the
longest match from here". A text is parsed against it greedily: a phrase ends
where the match ends. The cross-parsing entropy of a text of n characters
parsed into c phrases against N characters of a language is c * log2(N) / n
bits a character; the language with the fewest phrases so normalised wins.

The automata are fitted on a bounded sample of the labelled rows (documented
parameters). Prediction covers every whole text: blocks of ``block`` characters
are parsed side by side with table lookups, all languages at once.

The most frequent letters are one symbol each; every other letter is written as
the digits of its code point, so no two letters are taken for the same and the
tables keep their width whatever the scripts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import in_tasks, remainder
from tessera.llm._text import text_chunks

UNKNOWN = "und"
#: Symbols: 0 stands for everything but letters, the most frequent letters have
#: one each, and the last are the hexadecimal digits of the other letters.
CLASSES = 64
DIGITS = 16
RARE = 255


@dataclass
class Model:
    """Dense parsing tables: state * CLASSES + class -> next state * 4 + phrases ended."""

    languages: list[str]
    classes: np.ndarray
    tables: list[np.ndarray]
    bits: list[float]


def _lower(cp: int) -> int:
    return ord(chr(cp).lower()[0])


def _class_table(samples: list[str]) -> np.ndarray:
    """Symbol of every code point, letters in lower case; ``RARE`` for letters without one of their own."""
    points = np.arange(0x110000)
    letter = np.array([chr(p).isalpha() for p in points.tolist()])
    lower = points.copy()
    lower[letter] = [_lower(p) for p in points[letter].tolist()]
    table = np.where(letter, RARE, 0).astype(np.uint8)
    text = np.frombuffer("".join(samples).encode("utf-32-le"), dtype=np.uint32)
    found, count = np.unique(lower[text[letter[text]]], return_counts=True)
    own = found[np.lexsort((found, -count))][: CLASSES - DIGITS - 1]
    for k, p in enumerate(own.tolist(), 1):
        table[letter & (lower == p)] = k
    return table


def _normalise(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, runs of symbol 0 cut to one, and the texts' offsets.

    A letter without a symbol of its own is the four digits of its code point
    in lower case, five beyond the basic plane.
    """
    at = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=at[1:])
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    cls = classes[points]
    starts = at[offsets]
    size = (cls != 0).astype(np.int64)
    size[1:] |= cls[:-1] != 0
    size[starts[starts < len(cls)]] = 1
    rare = np.flatnonzero(cls == RARE)
    found, where = np.unique(points[rare], return_inverse=True)
    low = np.array([_lower(p) for p in found.tolist()], dtype=np.int64)[where]
    digits = np.where(low < 0x10000, 4, 5)
    size[rare] = digits
    place = np.zeros(len(cls) + 1, dtype=np.int64)
    np.cumsum(size, out=place[1:])
    out = np.repeat(cls, size)
    for d in range(int(digits.max(initial=0))):
        has = digits > d
        out[place[rare[has]] + d] = CLASSES - DIGITS + ((low[has] >> 4 * (digits[has] - 1 - d)) & 15)
    return out, place[starts]


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def _parsing_table(nxt: list[dict[int, int]]) -> np.ndarray:
    """Lookup table of the greedy parse; where no transition exists the phrase ends and the next one starts."""
    table = np.empty((len(nxt), CLASSES), dtype=np.int32)
    restart = np.full(CLASSES, 2, dtype=np.int32)  # the phrase and an unseen character each count
    for c, to in nxt[0].items():
        restart[c] = to * 4 + 1
    table[:] = restart
    table[0] = 1
    for state, moves in enumerate(nxt):
        for c, to in moves.items():
            table[state, c] = to * 4
    return table.ravel()


def fit(labelled: DataFrame, *, buckets: int = 128, chars: int = 256, total_chars: int = 1 << 19) -> Model:
    """Automata of the languages of ``labelled`` (text, lang); nulls are left out.

    Per language at most ``buckets`` passages of ``chars`` characters at
    pseudorandom places of pseudorandom texts are read (the text with the
    smallest hash of each bucket of hashes), and over all languages at most
    about ``total_chars`` characters and as many symbols: the model's size does
    not grow with the input or the number of languages.
    """
    rows = labelled.filter("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    picks = rows.groupBy("lang", F.expr(f"pmod(h, {buckets})").alias("bucket")).agg(F.min("h").alias("h"))
    picks = picks.select("lang", "h")
    place = F.expr(f"cast(1 + pmod(shiftright(h, 8), greatest(1, length(text) - {chars} + 1)) as int)")
    # The picks are at most `buckets` pairs of numbers a language.
    found = rows.join(F.broadcast(picks), ["lang", "h"]).groupBy("lang", "h").agg(
        F.min(F.substring("text", place, F.lit(chars))).alias("sample"))
    by_language: dict[str, list[tuple[int, str]]] = {}
    for r in found.collect():  # at most `buckets` short passages a language
        by_language.setdefault(r.lang, []).append((r.h, r.sample))
    languages = sorted(by_language)
    each = total_chars // max(1, len(languages))
    samples = {k: " ".join(s for _, s in sorted(v))[:each] for k, v in by_language.items()}
    classes = _class_table([samples[k] for k in languages])
    tables, bits = [], []
    for k in languages:
        raw = np.frombuffer(samples[k].encode(), dtype=np.uint8)
        symbols, _ = _normalise(raw, np.array([0, len(raw)]), classes)
        symbols = symbols[:each]
        tables.append(_parsing_table(_automaton(symbols.tolist())))
        bits.append(float(np.log2(max(2, len(symbols)))))
    return Model(languages, classes, tables, bits)


def _phrases(cls: np.ndarray, offsets: np.ndarray, tables: list[np.ndarray], block: int) -> np.ndarray:
    """Phrases per language and text of the greedy parse; a phrase never spans two blocks of a text."""
    size = np.diff(offsets)
    blocks = -(-size // block)
    doc = np.repeat(np.arange(len(size)), blocks)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = offsets[doc] + k * block
    length = np.minimum(block, offsets[doc + 1] - start)
    order = np.argsort(-length, kind="stable")
    start, length, doc = start[order], length[order], doc[order]
    active = np.searchsorted(-length, -np.arange(block))  # blocks longer than each step
    out = np.zeros((len(tables), len(size)), dtype=np.int64)
    state = [np.zeros(len(doc), dtype=np.int32) for _ in tables]
    count = [np.zeros(len(doc), dtype=np.int32) for _ in tables]
    for step in range(block):
        n = active[step]
        if not n:
            break
        c = cls[start[:n] + step]
        for t, table in enumerate(tables):
            s = state[t][:n]
            v = table[(s << 6) | c]
            count[t][:n] += v & 3
            np.right_shift(v, 2, out=s)
    for t in range(len(tables)):
        out[t] = np.bincount(doc, weights=count[t] + (state[t] > 0), minlength=len(size)).astype(np.int64)
    return out


def predict(docs: DataFrame, model: Model, *, block: int = 256, window: float = 8.0) -> DataFrame:
    """Rows (doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text).

    ``score`` is the winner's share of 2 ** (-window * entropy) over the
    languages: the posterior of a text of ``window`` characters at these rates.
    Texts without a letter (null and empty ones too) are ``und`` with score 0,
    as is everything where no language was learned. Ties go to the smaller
    language code.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches):
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            best = np.full(batch.num_rows, len(m.languages), dtype=np.int64)
            score = np.zeros(batch.num_rows)
            for row, offsets, data in text_chunks(batch.column("text")):
                cls, at = _normalise(data, offsets, m.classes)
                letters = np.zeros(len(cls) + 1, dtype=np.int64)
                np.cumsum(cls != 0, out=letters[1:])
                has = np.flatnonzero(letters[at[1:]] > letters[at[:-1]])
                if not len(has) or not m.languages:
                    continue
                rate = _phrases(cls, at, m.tables, block)[:, has] * np.array(m.bits)[:, None] / np.diff(at)[has]
                win = rate.argmin(axis=0)
                best[row + has] = win
                score[row + has] = 1 / (2.0 ** (-window * (rate - rate.min(axis=0)))).sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(
        in_tasks, compute, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang).

    Learns from the rows that are not held out and have an id, a text and a
    language; predicts from the text alone. Other columns are ignored, repeated
    rows are predicted alike, and an empty table gives no rows.
    """
    model = fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), **options)
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
