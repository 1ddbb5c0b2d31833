"""Hard negatives against all inner products; subset-sum scoring; rounds, hot labels and edge rows."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import hard_negatives as hn
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TOP = (1 << 63) - 1


def dot(a, b):
    return max(-TOP, min(TOP, sum(x * y for x, y in zip(a, b, strict=False))))


def brute(rows, every=100, scale=256):
    """rows: (id, vector, label); the result rows by sorting all scores of every anchor."""
    usable = {(i, None if v is None else tuple(v), l) for i, v, l in rows}
    usable = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in usable
              if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, l in usable:
        if i % every == 0:
            ranked = sorted((-dot(a, c), j, m) for j, c, m in usable if j != i)
            for p, pj in [(-s, j) for s, j, m in ranked if m == l][:5]:
                found = [(j, -s) for s, j, m in ranked if m != l and 30 * p <= 100 * -s <= 90 * p][:10]
                out += [(i, pj, r, j, p, s) for r, (j, s) in enumerate(found, 1)]
    return sorted(out)


def run(df, every=100, scale=256.0):
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % every == 0, scale=scale).collect())


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op13_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 40), st.integers(0, 20), st.sampled_from([1, 3, 300, 10**9, 10**13]))
def test_lookups_are_inner_products(seed, n, width, top):
    rng = np.random.default_rng(seed)
    a, c = (hn._pad(hn._integers(rng.integers(-top, top, (k, width), endpoint=True).astype(float)), -(-width // 8) * 8) for k in (3, n))
    got = hn.scores(hn.subset_sums(hn.fit(a, c)), hn.bit_planes(c))
    want = [[dot(x, y) for x in a.astype(object).tolist()] for y in c.astype(object).tolist()]
    assert got.tolist() == want


def test_rounds_blocks_and_a_hot_label(spark, monkeypatch):
    for name, value in (("RANGE", 64), ("BLOCK", 16), ("SIDE", 3), ("ROUND_BYTES", 700)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(7)
    labels = np.where(rng.random(500) < 0.34, 1, rng.integers(2, 12, 500))
    rows = [(i, [float(x) for x in rng.integers(-3, 6, 10) / 256], int(labels[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute(rows, every=20)
    assert want and run(df, every=20) == want


def test_one_very_common_vector(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(300)] + [(1000 + i, [0.5, 1.0 + i / 64], 2) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert run(df, every=50) == brute(rows, every=50)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, None, 1), (200, [None, 1.0], 1), (300, [nan, 1.0], 1), (400, [inf, 0.0], 2),
            (500, [1.0, 1.0], None), (1, [3.0], 1), (2, [], 1), (3, [-1.0, -1.0], 1), (None, [9.0, 9.0], 1), (4, [0.5, 1.0], 2),
            (5, [0.5, 1.0], 2), (0, [0.5, 0.9], 3), (6, [1.0, 0.1, 5.0], 4), (600, [2.0, 2.0], 9), (700, [], 1)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                               "vec_id long, embedding array<double>, label int, id long, at string, rank int")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == [] and run(df.filter("vec_id = 1")) == []
    assert run(spark.createDataFrame([(0, [], 1), (1, [], 1), (2, [], 2)], "vec_id long, embedding array<double>, label int")) == [
        (0, 1, 1, 2, 0, 0)]


def test_scores_beyond_a_long_are_held_at_its_limits(spark):
    rows = [(0, [1e12, 1.0], 1), (1, [1e12, 2.0], 1), (2, [1e300, 1e300], 1), (3, [1e12, 0.0], 2), (4, [1.0, 1.0], 2), (5, [1e6, 1.0], 2),
            (6, [1.7e308, 0.0], 1), (7, [80.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hn.mine(df, F.col("vec_id") == 0).collect()
    assert {r.positive_id for r in got} == {1, 2, 6} and {r.positive_score for r in got} == {TOP}
    assert {(r.negative_id, r.rank) for r in got} == {(7, 1)} and all(30 * TOP <= 100 * r.negative_score <= 90 * TOP for r in got)
