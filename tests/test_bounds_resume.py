"""Lloyd with bounds equals the full comparison; a fit goes on from its folder."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import bounds as bd
from tessera.operators import lloyd as ll


def points(spark, n, seed=1, spread=1000):
    rng = np.random.default_rng(seed)
    xy = np.concatenate([rng.integers(0, spread, (n, 2)), rng.normal(spread / 2, spread / 20, (n // 2, 2)).astype(int)])
    return spark.createDataFrame([(int(x), int(y)) for x, y in xy], "x int, y int"), [(int(x), int(y)) for x, y in xy[::7]]


@pytest.mark.parametrize("k", [1, 2, 60])
def test_same_centers_and_trace_as_all_distances(spark, k):
    df, seeds = points(spark, 900)
    want = ll.fit_lloyd(df, seeds[:k], eta=1.0, max_iter=4)
    means, history, work = bd.fit_lloyd_bounded(df, seeds[:k], eta=1.0, max_iter=4)
    assert (means, history) == want
    if k == 60:
        assert work[0]["distances"] < work[0]["full"] / 2 and work[-1]["distances"] < work[-1]["full"] / 8


def test_ties_repeated_centers_and_weights(spark):
    grid = [(x, y) for x in range(0, 40, 2) for y in range(0, 40, 2)]
    df = spark.createDataFrame([(x, y, 1 + (x * y) % 3) for x, y in grid], "x int, y int, w bigint")
    seeds = [(x, y) for x in range(1, 40, 6) for y in range(1, 40, 6)] + [(1, 1), (500, 500)]
    want = ll.fit_lloyd(df, seeds, eta=0.0, max_iter=3, weight="w")
    assert bd.fit_lloyd_bounded(df, seeds, eta=0.0, max_iter=3, weight="w")[:2] == want


def test_merged_cells(spark, monkeypatch):
    monkeypatch.setattr(bd, "MAX_CANDIDATES", 100)
    df, seeds = points(spark, 300)
    assert bd.fit_lloyd_bounded(df, seeds[:40], max_iter=2)[:2] == ll.fit_lloyd(df, seeds[:40], max_iter=2)


def test_null_coordinates_as_in_the_full_comparison(spark):
    df, seeds = points(spark, 300)
    odd = df.union(spark.createDataFrame([(None, 5), (7, None), (None, None), (None, 5)], df.schema))
    assert bd.fit_lloyd_bounded(odd, seeds[:30], eta=0.0, max_iter=3)[:2] == ll.fit_lloyd(odd, seeds[:30], eta=0.0, max_iter=3)


def test_a_pass_keeps_blocks_of_points(spark):
    df, seeds = points(spark, 4000)
    run = bd._Bounded(ll.point_histogram(df).repartition(2), seeds[:60], 8)
    means, n = run.update(seeds[:60]), ll.point_histogram(df).count()
    assert means == ll.lloyd_update(df, seeds[:60])
    assert run.points.count() <= 2 + n / 1000 and run.work[0]["points"] == n


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 30))
def test_candidates_hold_the_two_nearest(seed, k):
    rng = np.random.default_rng(seed)
    centers = [tuple(map(int, c)) for c in rng.integers(-50, 50, (k, 2))]
    low = rng.integers(-60, 50, (5, 2))
    high = low + rng.integers(0, 30, (5, 2))
    boxes = np.stack([low[:, 0], high[:, 0], low[:, 1], high[:, 1]], axis=1).astype(float)
    for (x0, x1, y0, y1), found in zip(boxes, bd.cell_candidates(boxes, centers), strict=True):
        for _ in range(10):
            x, y = rng.integers(x0, x1 + 1), rng.integers(y0, y1 + 1)
            d = sorted(((x - a) ** 2 + (y - b) ** 2, i) for i, (a, b) in enumerate(centers))
            assert d[0][1] in found
            assert len(d) < 2 or min(e for e, i in d if i != d[0][1]) >= min((e for e, i in d[1:] if i in found), default=0)


def test_resumed_fit_has_the_whole_trace(spark, tmp_path):
    df, seeds = points(spark, 400)
    want = ll.fit_lloyd(df, seeds[:9], eta=1.0, max_iter=8)
    state = str(tmp_path / "fit")
    ll.fit_lloyd(df, seeds[:9], eta=1.0, max_iter=5, state=state)
    assert ll.resume_lloyd(spark, state, max_iter=8) == want
    assert ll.resume_lloyd(spark, state, max_iter=8) == want  # nothing left to do
    with pytest.raises(ValueError):
        ll.fit_lloyd(df, seeds[:9], state=state)
    with pytest.raises(ValueError):
        ll.resume_lloyd(spark, str(tmp_path / "none"))


def test_half_written_pass_is_done_again(spark, tmp_path):
    df, seeds = points(spark, 400)
    want = ll.fit_lloyd(df, seeds[:9], eta=0.0, max_iter=4)
    state = str(tmp_path / "fit")
    ll.fit_lloyd(df, seeds[:9], eta=0.0, max_iter=2, state=state)
    (tmp_path / "fit" / "passes" / "iteration=3" / "_temporary" / "0").mkdir(parents=True)  # a driver lost while writing
    assert ll.resume_lloyd(spark, state, max_iter=4) == want


def test_bounded_fit_goes_on_too(spark, tmp_path):
    df, seeds = points(spark, 400)
    want = ll.fit_lloyd(df, seeds[:30], eta=0.0, max_iter=4)
    state = str(tmp_path / "fit")
    bd.fit_lloyd_bounded(df, seeds[:30], eta=0.0, max_iter=2, state=state)
    assert bd.fit_lloyd_bounded(df, seeds[:30], eta=0.0, max_iter=4, state=state)[:2] == want
