"""Exact grouped median by radix selection, against a brute-force sort."""

import random

import pytest

from tessera.operators.quantiles import exact_median


def brute(rows):
    by = {}
    for g, v, w in rows:
        if v is not None:
            by.setdefault(g, []).extend([v] * w)
    out = {}
    for g, vs in by.items():
        vs.sort()
        n = len(vs)
        s = vs[(n - 1) // 2] + vs[n // 2]
        out[g] = (n, abs(s) // 2 * (1 if s >= 0 else -1))   # mean truncated toward zero
    return out


@pytest.mark.parametrize("dtype,lo,hi", [
    ("int", -2**31, 2**31 - 1),
    ("int", -70000, 70000),
    ("int", -3, 3),
    ("bigint", -2**63, 2**63 - 1),
])
def test_matches_brute_force(spark, dtype, lo, hi):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 4), rnd.choice([None] + [rnd.randint(lo, hi)] * 9), rnd.randint(1, 3))
            for _ in range(600)]
    df = spark.createDataFrame(rows, f"g int, v {dtype}, w int")
    got = {r["g"]: (r["size"], r["median"]) for r in exact_median(df, "g", "v", "w").collect()}
    assert got == brute(rows)


def test_small_cases_unweighted(spark):
    rows = [(1, 1), (1, 2), (2, -3), (2, -2), (3, 5), (3, 9), (4, 7), (5, None), (5, 4)]
    df = spark.createDataFrame(rows, "g int, v int")
    got = sorted(tuple(r) for r in exact_median(df, "g", "v").collect())
    assert got == [(1, 2, 1), (2, 2, -2), (3, 2, 7), (4, 1, 7), (5, 1, 4)]


def test_rejects_non_integer(spark):
    df = spark.createDataFrame([(1, 1.5)], "g int, v double")
    with pytest.raises(TypeError):
        exact_median(df, "g", "v")


def test_window_partitions_bounded(spark):
    """A hot group with many distinct values: no window partition exceeds 2^16 digits."""
    df = spark.range(200_000).selectExpr("0 AS g", "CAST(id * 7919 % 1000003 - 500000 AS INT) AS v")
    vals = sorted(r[0] for r in df.select("v").collect())
    n = len(vals)
    expect = (vals[(n - 1) // 2] + vals[n // 2]) // 2 if vals[(n - 1) // 2] + vals[n // 2] >= 0 else \
        -((-(vals[(n - 1) // 2] + vals[n // 2])) // 2)
    got = exact_median(df, "g", "v").collect()
    assert [(r["size"], r["median"]) for r in got] == [(n, expect)]


def test_bounded_groups_broadcast_targets(spark):
    df = spark.range(5000).selectExpr("id % 3 AS g", "CAST(id * 37 % 1001 AS INT) AS v")
    free = sorted(tuple(r) for r in exact_median(df, "g", "v").collect())
    med = exact_median(df, "g", "v", broadcast_targets=True)
    assert sorted(tuple(r) for r in med.collect()) == free
    plan = med._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
