"""Top-k search against all inner products, pruning, edge rows."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import topk_search as ts
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, k=20):
    usable = []
    for i, v in {(i, None if v is None else tuple(v)): (i, v) for i, v in rows}.values():
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for i, q in usable:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), j) for j, c in usable if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def test_query_matches_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op8_topk_search"](spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_many_ranges_and_groups(spark, monkeypatch):
    for name, value in (("RANGE", 32), ("BLOCK", 8), ("GROUP", 3)):
        monkeypatch.setattr(ts, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 64]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ts.top_k(df, df.vec_id % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_near_ids_near_vectors_ship_few_pairs(spark, monkeypatch):
    """Clusters of neighbouring ids: a group of queries sees few ranges, results whole; all alike, it sees all."""
    for name, value in (("RANGE", 40), ("BLOCK", 8), ("GROUP", 20), ("PACK", 3)):
        monkeypatch.setattr(ts, name, value)
    rng = np.random.default_rng(9)

    def pairs(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert sorted(tuple(r) for r in ts.top_k(df, df.vec_id % 20 == 0, k=5).collect()) == brute(rows, 5)
        v = df.select(df.vec_id.alias("id"), df.embedding.alias("v"), (df.vec_id % 20 == 0).alias("q"))
        laid = ts.lay_out(v, 40, k=5, scale=64.0)
        asked = ts.query_groups(laid, 4)
        open_ = ts.open_pairs(laid, asked, 4)
        assert open_.distinct().count() == open_.count()
        return open_.count(), laid.count() * asked.count()

    axis = np.eye(8)
    shipped, all_ = pairs([(i, [float(x) for x in 4 * axis[i // 200] + rng.normal(0, 0.05, 8)]) for i in range(1600)])
    assert shipped < all_ / 2
    shipped, all_ = pairs([(i, [1.0, 2.0]) for i in range(1600)])
    assert shipped == all_


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 60), st.integers(1, 5), st.sampled_from([3, 1000, 10**12]))
def test_range_is_exact(seed, n, k, top):
    rng = np.random.default_rng(seed)
    m, ids = rng.integers(-top, top, (n, 4)).astype(float), rng.permutation(n)
    q = m[:3]
    row, i, s, _ = ts.search_range(q, ids[:3], m, ids, k, block=8)
    got = sorted(zip(row.tolist(), i.tolist(), [int(x) for x in s], strict=True))
    want = []
    for r in range(len(q)):
        all_ = sorted((-sum(int(a) * int(b) for a, b in zip(q[r], m[c], strict=True)), ids[c]) for c in range(n) if ids[c] != ids[r])
        want += [(r, int(j), -v) for v, j in all_[:k]]
    assert got == sorted(want)


def test_blocks_are_pruned():
    m = np.repeat(np.arange(40.0), 32)[:, None] * np.ones((1, 3))
    ids = np.arange(len(m))
    *_, scored = ts.search_range(np.ones((1, 3)), np.array([-1]), m, ids, 20, block=32)
    assert scored <= 2


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, None), (40, [None, 1.0]), (60, [nan, 1.0]), (80, [inf, 0.0]), (1, [3.0]),
            (2, []), (3, [-1.0, -1.0]), (None, [9.0, 9.0]), (100, [2.5e18, 1.0]), (4, [1.0, 2.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, rank int, id int")
    got = sorted(tuple(r) for r in ts.top_k(df, df.vec_id % 20 == 0, scale=1.0).collect())
    usable = [r for r in rows if r[0] != 100]
    assert [g for g in got if g[0] == 0][0] == (0, 1, 100, int(2.5e18) + 2)
    assert len([g for g in got if g[0] == 0]) == 6 and {g[0] for g in got} == {0, 100}
    df = spark.createDataFrame(usable, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in ts.top_k(df, df.vec_id % 20 == 0).collect()) == brute(usable)
    assert ts.top_k(df.limit(0), df.vec_id % 20 == 0).collect() == []
    assert ts.top_k(df, df.vec_id < 0).collect() == []


def test_scores_beyond_a_long_are_held_at_its_limits(spark, monkeypatch):
    monkeypatch.setattr(ts, "RANGE", 3)
    rows = [(0, [1e12, 1.0]), (1, [1e12, 2.0]), (2, [1e300, -1e300]), (3, [-1e12, 5.0]), (4, [0.0, 1.0]), (5, [1.7e308, 0.0]), (6, [1e12, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in ts.top_k(df, df.vec_id == 0, k=5).collect())
    assert got == [(1, 1, ts.LIMIT), (2, 2, ts.LIMIT), (3, 5, ts.LIMIT), (4, 6, ts.LIMIT), (5, 4, 64 * 64)]
