import numpy as np
import pytest

from conftest import rows
from tessera.operators import clusters as cl
from tessera.operators import lloyd as ll
from tessera.operators import vectors as vc


def scored(spark, items):
    return spark.createDataFrame(items, "qid long, tag string, score int")


def test_vectors_positions(spark):
    df = scored(spark, [(1, "JavaScript", 3), (2, "Java", 5), (3, "C#", -2)])
    assert sorted(rows(vc.to_vectors(df))) == [(1, 0, 3), (2, 50000, 5), (3, 200000, -2)]


@pytest.mark.parametrize("tag", ["Cobol", None])
def test_unknown_tag(spark, tag):
    df = scored(spark, [(1, tag, 3), (2, "Java", 5)])
    with pytest.raises(Exception, match="tag not in list"):
        vc.to_vectors(df).collect()
    assert rows(vc.to_vectors(df, on_unknown="drop")) == [(2, 50000, 5)]


def points(spark, xy):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "id long, x int, y int")


def test_seed_centers_n_per_stratum(spark):
    xy = [(x, y) for x in (0, 50000, 100000) for y in range(20)]
    seeds = vc.seed_centers(points(spark, xy), 4, [0, 50000, 100000])
    got = rows(seeds)
    assert len(got) == 12
    per = {}
    for _, x, _, _ in got:
        per[x] = per.get(x, 0) + 1
    assert per == {0: 4, 50000: 4, 100000: 4}
    assert sorted(r[3] for r in got) == list(range(12))
    assert rows(vc.seed_centers(points(spark, xy), 4, [0, 50000, 100000])) == got  # deterministic
    plan = seeds._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_seed_plan_has_group_limit(spark):
    xy = [(x, y) for x in (0, 50000) for y in range(10)]
    seeds = vc.seed_centers(points(spark, xy), 2, [0, 50000])
    seeds.collect()
    plan = seeds._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_too_few_points_detected(spark):
    xy = [(0, 1), (0, 2), (0, 3), (50000, 1)]
    seeds = vc.seed_centers(points(spark, xy), 2, [0, 50000])
    with pytest.raises(ValueError):
        ll.collect_centers(seeds, expected=4)


def test_plain_sample_exact(spark):
    xy = [(0, y) for y in range(50)]
    s = rows(vc.plain_sample(points(spark, xy), 7))
    assert len(s) == 7 and len(set(s)) == 7
    with pytest.raises(ValueError):
        vc.centers_per_stratum(45, 7)
    assert vc.centers_per_stratum(45, 15) == 3


def test_nearest_tie_lowest_index(spark):
    df = points(spark, [(5, 0)])
    got = rows(ll.assign_nearest(df, [(10, 0), (0, 0), (5, 100)]))
    assert got[0][3] == 0


def test_centroid_truncates_toward_zero(spark):
    df = points(spark, [(0, -3), (0, -4)])
    assert ll.lloyd_update(df, [(0, 0)]) == [(0, -3)]


def test_empty_cluster_keeps_center(spark):
    df = points(spark, [(0, 1), (0, 3)])
    assert ll.lloyd_update(df, [(0, 0), (900000, 900000)]) == [(0, 2), (900000, 900000)]


def brute_fit(xy, centers, eta, max_iter):
    pts = np.asarray(xy, dtype=np.int64)
    means = [tuple(c) for c in centers]
    for _ in range(max_iter):
        c = np.asarray(means, dtype=np.float64)
        d = ((pts[:, None, 0] - c[None, :, 0]) ** 2 + (pts[:, None, 1] - c[None, :, 1]) ** 2)
        lab = np.argmin(d, axis=1)
        new = list(means)
        for k in range(len(means)):
            sel = pts[lab == k]
            if len(sel):
                new[k] = (int(np.trunc(sel[:, 0].sum() / len(sel))), int(np.trunc(sel[:, 1].sum() / len(sel))))
        moved = sum((a - c_) ** 2 + (b - d_) ** 2 for (a, b), (c_, d_) in zip(means, new))
        means = new
        if moved < eta:
            break
    return means


def test_fit_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    xy = [(int(x) * 50000, int(y)) for x, y in zip(rng.integers(0, 4, 400), rng.integers(-30, 200, 400))]
    centers = [xy[i] for i in (0, 5, 9, 13, 40, 77)]
    means, hist = ll.fit_lloyd(points(spark, xy), centers, eta=20.0, max_iter=45)
    assert means == brute_fit(xy, centers, 20.0, 45)
    means_raw, _ = ll.fit_lloyd(points(spark, xy), centers, eta=20.0, max_iter=45, fold=False)
    assert means_raw == means
    assert len(hist) % len(centers) == 0


def test_many_centers_match_the_inline_form(spark):
    rng = np.random.default_rng(3)
    xy = [(int(x), int(y)) for x, y in zip(rng.integers(0, 1000, 300), rng.integers(0, 1000, 300))]
    centers = [(int(a), int(b)) for a, b in zip(rng.integers(0, 1000, 400), rng.integers(0, 1000, 400))]
    centers += [centers[0]]  # duplicate center: the tie must go to the lower index
    got = {r[0]: r[3] for r in rows(ll.assign_nearest(points(spark, xy), centers))}
    c = np.asarray(centers, dtype=np.float64)
    for i, (x, y) in enumerate(xy):
        assert got[i] == int(np.argmin((c[:, 0] - x) ** 2 + (c[:, 1] - y) ** 2))
    inline = ll.assign_nearest(points(spark, xy), centers[:20], inline=True)
    assert sorted(rows(inline)) == sorted(rows(ll.assign_nearest(points(spark, xy), centers[:20])))


def test_a_column_named_w_is_only_data(spark):
    df = spark.createDataFrame([(0, 1, 100), (0, 3, 1)], "x int, y int, w int")
    assert ll.lloyd_update(df, [(0, 0)]) == [(0, 2)]
    assert ll.lloyd_update(df, [(0, 0)], weight="w") == [(0, 1)]
    assert ll.fit_lloyd(df, [(0, 0)])[0] == [(0, 2)]
    summary = cl.summarize_clusters(df, [(0, 0)], ("A",))
    assert [r["size"] for r in summary.collect()] == [2]


@pytest.mark.parametrize("kwargs,xy", [({"spread": 50000}, [(0, 1), (0, 2), (0, 3), (50000, 1)]), ({"spread": 10}, [(0, 1), (0, 2)])])
def test_short_draws_fail(spark, kwargs, xy):
    with pytest.raises(ValueError, match="centers"):
        vc.initial_centers(points(spark, xy), 4, ("A", "B"), **kwargs)


def test_total_movement():
    assert ll.total_movement([(0, 0), (1, 1)], [(3, 4), (1, 1)]) == 25.0
    with pytest.raises(ValueError):
        ll.total_movement([(0, 0)], [])


def summary_of(spark, xy, centers, tags=("A", "B", "C")):
    return rows(cl.summarize_clusters(points(spark, xy), centers, tags, spread=50000))


@pytest.mark.parametrize("ys,median", [([1, 2], 1), ([-3, -2], -2), ([5, 9], 7), ([4], 4), ([1, 5, 2], 2)])
def test_median(spark, ys, median):
    got = summary_of(spark, [(0, y) for y in ys], [(0, 0)])
    assert got[0][4] == median


def test_label_share_size(spark):
    xy = [(50000, 1), (50000, 2), (0, 3)]
    got = summary_of(spark, xy, [(25000, 0)])
    assert got == [(0, "B", 66.0, 3, 2)]


def test_label_tie_lowest_x(spark):
    xy = [(100000, 1), (0, 2)]
    got = summary_of(spark, xy, [(50000, 0)])
    assert got[0][1] == "A" and got[0][2] == 50.0


def test_summary_order_and_report(spark):
    xy = [(0, 10), (0, 11), (100000, -5)]
    summ = cl.summarize_clusters(points(spark, xy), [(0, 10), (100000, -5)], ("A", "B", "C"), spread=50000)
    assert [r[0] for r in rows(summ)] == [1, 0]
    lines = [r[1] for r in rows(cl.cluster_report(summ))]
    assert lines[0] == "     -5  C                 (100.0%)            1"
    assert lines[1] == "     10  A                 (100.0%)            2"


def test_print_report_header_and_lines(spark):
    import io
    xy = [(0, 10), (0, 11), (100000, -5)]
    summ = cl.summarize_clusters(points(spark, xy), [(0, 10), (100000, -5)], ("A", "B", "C"), spread=50000)
    buf = io.StringIO()
    cl.print_report(summ, buf)
    assert buf.getvalue().splitlines() == [*cl.REPORT_HEADER,
                                           "     -5  C                 (100.0%)            1",
                                           "     10  A                 (100.0%)            2"]


def test_initial_centers_rule(spark):
    xy = [(x, y) for x in (0, 50000, 100000) for y in range(10)]
    strat = rows(vc.initial_centers(points(spark, xy), 6, ("A", "B", "C"), spread=50000))
    assert sorted(r[3] for r in strat) == list(range(6))
    assert sorted({r[1] for r in strat}) == [0, 50000, 100000]
    small = [(x, y) for x in (0, 100, 200) for y in range(10)]
    plain = rows(vc.initial_centers(points(spark, small), 4, ("A", "B", "C"), spread=100))
    assert len(plain) == 4 and sorted(r[3] for r in plain) == [0, 1, 2, 3]
    expect = [tuple(r)[:3] for r in vc.plain_sample(points(spark, small), 4).collect()]
    assert sorted(r[:3] for r in plain) == sorted(expect)
    with pytest.raises(ValueError):
        vc.initial_centers(points(spark, xy), 7, ("A", "B", "C"), spread=50000)


def brute_summary(xy, centers, tags, spread):
    groups = {}
    for x, y in xy:
        d = [(float(x - cx) ** 2 + float(y - cy) ** 2, i) for i, (cx, cy) in enumerate(centers)]
        groups.setdefault(min(d)[1], []).append((x, y))
    out = []
    for c, ps in groups.items():
        counts = {}
        for x, _ in ps:
            counts[x] = counts.get(x, 0) + 1
        top_x = min(counts, key=lambda x: (-counts[x], x))
        ys = sorted(y for _, y in ps)
        n = len(ys)
        s = ys[(n - 1) // 2] + ys[n // 2]
        med = abs(s) // 2 * (1 if s >= 0 else -1)
        out.append((c, tags[top_x // spread], float(counts[top_x] * 100 // n), n, med))
    return sorted(out, key=lambda r: (r[4], r[0]))


@pytest.mark.parametrize("seed", [11, 12])
def test_summary_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    xy = [(int(x) * 50000, int(y)) for x, y in zip(rng.integers(0, 5, 700), rng.integers(-40, 60, 700))]
    centers = [(int(x) * 50000, int(y)) for x, y in zip(rng.integers(0, 5, 8), rng.integers(-40, 60, 8))]
    tags = ("A", "B", "C", "D", "E")
    assert summary_of(spark, xy, centers, tags) == brute_summary(xy, centers, tags, 50000)


def test_array_form_matches_literal_form(spark):
    from tessera.functions.geometry import nearest_center, nearest_center_array
    rng = np.random.default_rng(5)
    xy = [(int(x), int(y)) for x, y in zip(rng.integers(-500, 500, 400), rng.integers(-500, 500, 400))]
    centers = [(int(a), int(b)) for a, b in zip(rng.integers(-500, 500, 12), rng.integers(-500, 500, 12))]
    centers += [centers[3], (0, 0), (0, 0)]  # duplicates: ties go to the lower index
    xy += [(0, 0), (5, 5)]
    df = points(spark, xy)
    lit = df.select("id", nearest_center("x", "y", centers).cast("int").alias("c"))
    arr = df.select("id", nearest_center_array("x", "y", centers).cast("int").alias("c"))
    assert sorted(rows(lit)) == sorted(rows(arr))
    # a histogram input takes the array form inside assign_nearest
    hist = ll.point_histogram(df)
    got = {(r["x"], r["y"]): r["cluster"] for r in ll.assign_nearest(hist, centers).collect()}
    want = {(r["x"], r["y"]): r["cluster"] for r in ll.assign_nearest(df, centers).collect()}
    assert got == want


def test_seeding_has_no_single_partition(spark):
    xy = [(x, y) for x in (0, 50000, 100000, 150000) for y in range(15)]
    drawn = vc.seed_centers(points(spark, xy), 4, [0, 50000, 100000])
    assert sorted((r[3], r[1]) for r in drawn.collect()) == [(i, 50000 * (i // 4)) for i in range(12)]
    assert "SinglePartition" not in drawn._jdf.queryExecution().executedPlan().toString()
