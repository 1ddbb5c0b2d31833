"""Spelling variants against plain Python; edit hashes, filters in rounds, edge rows."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import spelling as sp
from tessera.llm._text import text_chunks
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LETTERS = "".join(chr(c) for c in sp.LETTERS.tolist())


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counts(rows):
    c = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def brute(rows, neighbours=None):
    n = counts(rows)
    if neighbours is None:
        neighbours = {w: [u for u in n if near(w, u)] for w in n}
    form = {}
    for w, us in neighbours.items():
        best = min(us, key=lambda u: (-n[u], u), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(neighbours[w]), n[form[w]] if w in form else None))
    return sorted(out)


def by_pattern(n):
    """Near words by shared patterns, for vocabularies too large for all pairs."""
    found, groups = {w: set() for w in n}, {}
    for w in n:
        for i in range(len(w)):
            groups.setdefault((i, w[:i], w[i + 1:]), []).append(w)
            u = w[:i] + w[i + 1:]
            if u in n:
                found[w].add(u)
                found[u].add(w)
    for g in groups.values():
        for a in g:
            found[a].update(x for x in g if x != a)
    return found


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    return sorted((tuple(r) for r in sp.variants(df).collect()))


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == brute(rows, by_pattern(counts(rows)))
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got)


def test_by_pattern_is_near():
    n = {w: 1 for w in ("abcdef", "abcdeg", "abcde", "abcdeff", "bbcdef", "xabcdef", "aabcdef", "abdcef", "zzzzzz")}
    assert by_pattern(n) == {w: {u for u in n if near(w, u)} for w in n}


def test_chains_ties_and_accents(spark):
    words = {"center": 700, "centre": 6, "centers": 130, "centerss": 25, "centersst": 5, "entrées": 40, "entrees": 5, "Entrées": 1,
             "aaaaaa": 30, "aaaaaaa": 6, "aaaaaab": 30, "aaaaaac": 5, "straße×": 5, "short": 99, "ÀÉÎÕÜÝ": 5, "àéîõüý": 50, "ÀéîõüÝ": 7}
    rows = [(k, " ".join([w] * n) + ".") for k, (w, n) in enumerate(words.items())]
    got = run(spark, rows)
    assert got == brute(rows)
    forms = {r[0]: (r[1], r[2]) for r in got}
    assert forms["centersst"] == ("centerss", "center") and forms["aaaaaac"][0] == "aaaaaa"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(LETTERS, min_size=2, max_size=12), min_size=1, max_size=8))
def test_edit_hashes(words):
    w = sp._Words(words)

    def one(x):
        return int(sp._Words([x]).hashes()[0])
    assert w.hashes().tolist() == [one(x) for x in words]
    p, h = w.deletions(1)
    edits = [w.edited(x, "") for x in p.tolist()]
    assert h.tolist() == [one(x) for x in edits]
    assert sorted(zip(w.word[p].tolist(), edits, strict=True)) == sorted({(k, x[:i] + x[i + 1:]) for k, x in enumerate(words) for i in range(len(x))})
    for letter in "aé":
        p, h = w.replacements(ord(letter))
        edits = [w.edited(x, letter) for x in p.tolist()]
        assert h.tolist() == [one(x) for x in edits] and all(e < w.words[k] for e, k in zip(edits, w.word[p].tolist(), strict=True))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99), st.text("abÀÿ7 ", max_size=200)), max_size=6))
def test_checksums(rows):
    import pyarrow as pa
    for row, offsets, data in text_chunks(pa.array([t for _, t in rows], pa.large_string())):
        r = sp._Runs(data, offsets, 1)
        seeds = np.array([zlib.crc32(f"{d}:".encode()) for d, _ in rows[row:]], dtype=np.uint32)
        words = r.words(np.ones(len(r.starts), dtype=bool)).to_pylist()
        assert words == [w for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", t)]
        assert sp.checksums(r.data, r.starts, r.ends, seeds[r.doc]).tolist() == [
            zlib.crc32(f"{rows[d][0]}:{w}".encode()) for d, w in zip(r.doc.tolist(), words, strict=True)]


def test_filters_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 6, rng.integers(6, 9))) for _ in range(1500)]
    rows = [(None, " ".join(w + " " + w for w in words) + " " + " ".join(words)), (1, " ".join(words)), (2, " ".join(words))]
    want = brute(rows, by_pattern(counts(rows)))
    assert run(spark, rows) == want and sum(r[4] for r in want) > 100
    monkeypatch.setattr(sp, "SHARD_WORDS", 100)
    monkeypatch.setattr(sp, "ROUND_BYTES", 1024)
    monkeypatch.setattr(sp, "PROBED", 500)
    plan = sp.Plan({7: 900, 6: 300, 8: 1})
    assert len(plan.rounds) > 2 and plan.rounds[0][0] == 0
    assert all(a[1] == b[0] for a, b in zip(plan.rounds[:-1], plan.rounds[1:], strict=True))
    assert run(spark, rows) == want


def test_edges(spark):
    long = "q" * 5000
    rows = [(1, None), (2, ""), (3, "12 ... \n"), (4, " ".join([long] * 5 + [long + "r"] * 30)), (5, "ab" * 40000), (None, "bananas " * 5),
            (6, "banana " * 30), (6, "banana " * 30), (7, "BANANA Banana x" * 3)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0] for r in got} >= {"banana", "bananas", long} and run(spark, []) == []
