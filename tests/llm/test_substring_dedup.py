"""Substring dedup against plain Python: runs of sentences alone, and with all windows of 20 words; planted passages, edge rows."""

import re

import numpy as np

from tessera.llm import substring_dedup as sd
from tessera.llm._text import ALNUM, find_words, segment_hashes
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(raw):
    return bytes(b + 32 if 65 <= b < 91 else b for b in raw)


def word_hash(w):
    a = np.frombuffer(w, dtype=np.uint8)
    s, e, _ = find_words(a, np.array([0, len(a)]), ALNUM)
    return int(segment_hashes(a, s, e)[0])


def units(text):
    """[(byte start, byte end, words)] of a text."""
    raw = lower((text or "").encode())
    at = [(m.start(), m[0]) for m in WORD.finditer(raw)]
    stops = [m.end() for m in re.finditer(rb"[.!?](?=[\x20\x09-\x0D]|\Z)|\n|\xe3\x80\x82", raw)]
    groups = {}
    for pos, w in at:
        groups.setdefault(sum(s <= pos for s in stops), []).append((pos, w))
    out = []
    for _, g in sorted(groups.items()):
        cur = []
        for k, (pos, w) in enumerate(g):
            if cur and len(g) > sd.LONG and word_hash(g[k - 1][1]) & 7 == 0:
                out.append(cur)
                cur = []
            cur.append((pos, w))
        out.append(cur)
    starts = [u[0][0] for u in out] + [len(raw)]
    return [(starts[i], starts[i + 1], tuple(w for _, w in u)) for i, u in enumerate(out)]


def span_places(us, sentences, words):
    """(first unit, last unit + 1) of the runs of sentences."""
    found = set()
    for i in range(len(us)):
        for j in range(i + sentences, len(us) + 1):
            if sum(len(u[2]) for u in us[i:j]) >= words:
                found.add((i, j))
                break
    for j in range(len(us), 0, -1):
        for i in range(j - sentences, -1, -1):
            if sum(len(u[2]) for u in us[i:j]) >= words:
                found.add((i, j))
                break
    return sorted(found)


def brute(rows, sentences=sd.SENTENCES, words=sd.WORDS, windows=True):
    """The result rows: what a run of sentences or a window covers goes, if it stands earlier in its row or under a smaller id."""
    docs, least = [], {}
    for d, t in rows:
        us = units(t)
        at = [0]
        for u in us:
            at.append(at[-1] + len(u[2]))
        flat = [w for u in us for w in u[2]]
        pieces = [("run", at[i], at[j], tuple(u[2] for u in us[i:j])) for i, j in span_places(us, sentences, words)]
        if windows:
            pieces += [("window", i, i + words, tuple(flat[i:i + words])) for i in range(len(flat) - words + 1)]
        order = (d is None, d or 0)
        docs.append((d, t, us, at, pieces, order))
        for kind, _, _, key in pieces:
            least[kind, key] = min(least.get((kind, key), order), order)
    out = []
    for d, t, us, at, pieces, order in docs:
        gone, seen = set(), set()
        for kind, i, j, key in pieces:
            if least[kind, key] < order or (kind, key) in seen:
                gone.update(range(i, j))
            seen.add((kind, key))
        raw = (t or "").encode()
        starts = [m.start() for m in WORD.finditer(lower(raw))] + [len(raw)]
        kept, pos = b"", 0
        for k in sorted(gone):
            kept += raw[pos:starts[k]]
            pos = starts[k + 1]
        kept += raw[pos:]
        whole = sum(all(k in gone for k in range(a, b)) for a, b in zip(at[:-1], at[1:], strict=True))
        out.append((d, len(us), whole, len(gone), None if t is None else kept.decode()))
    return sorted(out, key=str)


def run(spark, rows, **kwargs):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, run int")
    return sorted((tuple(r) for r in sd.remove_repeats(df, **kwargs).collect()), key=str)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op10_substring_dedup"](spark, SF).collect()), key=str)
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_runs_of_sentences_alone(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in df.collect()], windows=False)
    got = sorted((tuple(r) for r in sd.remove_repeats(df, windows=False).collect()), key=str)
    assert got == want and any(r[2] for r in got)


def passage(tag, n, per):
    w = [f"{tag}{i}" for i in range(n)]
    return " ".join(" ".join(w[i:i + per]) + "." for i in range(0, n, per))


def test_planted_passages(spark):
    for n, per in ((55, 8), (60, 30), (51, 17), (80, 3)):
        p = passage("p", n, per)
        rows = [(i, f"{passage(f'a{i}x', 40, 7)} {p} {passage(f'b{i}x', 40, 9)}") for i in range(6)]
        got = run(spark, rows)
        assert got == brute(rows)
        assert [r[3] for r in got] == [0] + [n] * 5
        assert all(" p0 " not in r[4] for r in got[1:])
        alone = run(spark, rows, windows=False)
        assert alone == brute(rows, windows=False) and [r[3] for r in alone] == [0] + [n] * 5


def test_passage_without_sentence_ends(spark):
    p = " ".join(f"q{i}" for i in range(120))
    rows = [(i, " ".join(f"c{i}_{k}" for k in range(30)) + " " + p + " " + " ".join(f"d{i}_{k}" for k in range(30))) for i in range(4)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got] == [0, 121, 121, 121]  # with the 29 that stands before it everywhere
    alone = run(spark, rows, windows=False)
    assert alone == brute(rows, windows=False) and all(r[3] > 80 for r in alone[1:])


def test_edges(spark):
    p = passage("z", 30, 5)
    long = " ".join(passage(f"l{i}x", 50, 6) for i in range(600))
    rows = [(5, None), (6, ""), (7, "...\n\n!"), (1, p), (1, p), (2, p + "\n" + p), (None, p), (None, p), (3, "short one."),
            (4, "short one."), (8, long), (9, long + " " + p), (10, "Ünïcode。 " + p)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert run(spark, rows, windows=False) == brute(rows, windows=False)
    assert run(spark, []) == [] and run(spark, [], windows=False) == []


def words(tag, n):
    return [f"{tag}{i}" for i in range(n)]


def test_passages_without_stops(spark):
    for n in (20, 21, 27, 51):
        for k in range(5):
            p = words(f"p{k}x", n)
            rows = [(i, " ".join(words(f"a{i}x", 30) + p + words(f"b{i}x", 30))) for i in range(3)]
            got = run(spark, rows)
            assert got == brute(rows)
            assert [r[3] for r in got] == [0, n, n]
    rows = [(i, " ".join(words(f"a{i}x", 30) + words("p", 19) + words(f"b{i}x", 30))) for i in range(3)]
    assert [r[3] for r in run(spark, rows)] == [0, 0, 0]


def test_same_words_under_other_stops_and_lines(spark):
    p = words("p", 51)
    ways = [" ".join(p), "\n".join(" ".join(p[i:i + 7]) for i in range(0, 51, 7)), ". ".join(" ".join(p[i:i + 10]) for i in range(0, 51, 10)),
            ", ".join(p).upper(), "! ".join(p)]
    rows = [(i, f"Own start s{i} {way} e{i} own end.") for i, way in enumerate(ways)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got] == [0, 51, 51, 51, 51]
    assert all(r[4] == f"Own start s{r[0]} e{r[0]} own end." for r in got[1:])


def test_repeats_inside_a_row_and_short_rows(spark):
    p = " ".join(words("p", 40))
    rows = [(1, p + "\n" + p), (2, " ".join(words("q", 11))), (3, " ".join(words("q", 11))), (4, "x y " * 30), (5, "x y " * 30),
            (None, p), (None, "own words " + p), (6, None), (7, "")]
    assert run(spark, rows) == brute(rows)
