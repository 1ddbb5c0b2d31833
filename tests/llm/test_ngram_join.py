"""N-gram Jaccard join against all-pairs counting in plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from tessera.llm import ngram_join
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, threshold=0.8):
    """{(doc_id, text): (class_id, n_links)} of (doc_id, text) rows, by overlap counting."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j != i)
        for j, c in common.items():
            if c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9:
                links[i] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i)), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in ngram_join.near_duplicates(df, **options).collect()), key=str)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_ngram_jaccard_join"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_groups_of_near_copies_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):  # one group of near copies, more than a leaf and a block
        words = list(base)
        words[i] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base)) for i in range(7)]  # exact copies
    rows += [(200 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(5)]
    assert run(spark, rows, leaf=4) == brute(rows)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "... !!"), (4, "one two"), (5, "One, two."), (6, "one two three"),
            (7, long), (8, long + " end"), (9, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"),
            (None, "solo text of a null id")]
    got = run(spark, rows)
    want = sorted(brute([r for r in rows if shingles(r[1])]) + [(1, 1, 0), (2, 2, 0), (3, 3, 0)], key=str)
    assert got == want


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a b c", 7, 8, "z"), (2, "a b c", 9, 8, "y")],
                               "doc_id long, text string, node int, root int, path string")
    assert sorted(tuple(r) for r in ngram_join.near_duplicates(df).collect()) == [(1, 1, 1), (2, 1, 1)]
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("threshold,levels", [(0.8, 1), (0.8, 3)])
def test_runs(threshold, levels):
    n = ngram_join.runs_needed(threshold, levels, 0.9999)
    assert (1 - threshold ** levels) ** n <= 1e-4 < (1 - threshold ** levels) ** (n - 1)


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ngram_join.keep_one(df).collect()), key=str)


def test_one_of_each_group_under_null_and_shared_ids(spark):
    a = " ".join(f"word{i}" for i in range(60))
    near, solo, other = a + " z", " ".join(f"solo{i}" for i in range(30)), " ".join(f"other{i}" for i in range(30))
    assert kept(spark, [(3, a), (None, a), (None, near), (None, solo)]) == sorted([(3, a), (None, solo)], key=str)
    assert kept(spark, [(3, a), (5, near), (5, other)]) == [(3, a), (5, other)]
    assert len(kept(spark, [(None, a), (None, near), (None, a)])) == 1
    assert len(kept(spark, [(7, a), (7, near), (7, a), (7, None), (7, ""), (None, ""), (None, "")])) == 4
    third = [(None if i % 3 == 0 else i, f"{a} tail{i}" if i % 2 else solo) for i in range(60)]
    assert [r[0] for r in kept(spark, third)] == [1, 2]
