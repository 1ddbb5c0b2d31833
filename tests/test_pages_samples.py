"""Nested pairs in pages, numbering by ranges, samples of strata found in the data."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import pairs as pr
from tessera.operators import vectors as vc
from tessera.operators.numbering import number_rows, rank_in_groups

POSTS = "ptype int, id bigint, accepted bigint, parent bigint, score int, tag string"


def posts(spark, data):
    return spark.createDataFrame(data, POSTS)


def nested(data, size):
    """By plain lists: (qid, tag, page, [(aid, score)])."""
    out = []
    for q in [d for d in data if d[0] == 1]:
        mine = sorted((d[1], d[4]) for d in data if d[0] == 2 and d[3] == q[1])
        out += [(q[1], q[5], i // size, mine[i: i + size]) for i in range(0, len(mine), size)]
    return sorted(out)


def paged(df, size, **kwargs):
    return sorted((r.qid, r.tag, r.page, [tuple(a) for a in r.answers]) for r in pr.pair_pages(df, page_size=size, **kwargs).collect())


@pytest.mark.parametrize("size", [1, 3, 100])
def test_pages_match_lists(spark, size):
    data = [(1, q, None, None, 1, f"t{q}") for q in range(6)]
    data += [(2, 100 + i, None, i % 5 if i % 3 else 2, i % 7, None) for i in range(40)] + [(2, 500, None, 77, 1, None)]
    assert paged(posts(spark, data), size) == nested(data, size)


def test_hot_question_spreads_over_pages(spark):
    data = [(1, q, None, None, 1, "t") for q in range(50)]
    data += [(2, 1000 + i, None, 7 if i % 3 == 0 else i % 50, i % 11, None) for i in range(3000)]
    df = posts(spark, data).repartition(6)
    got = paged(df, 20)
    assert got == nested(data, 20) and max(len(a) for _, _, _, a in got) == 20
    best = rows(pr.best_score_of_pages(pr.pair_pages(df, page_size=20), floor=3))
    assert sorted(best) == sorted(rows(pr.best_child_score(df, floor=3).select("qid", "tag", "score")))


def test_answer_without_parent_fails_or_goes(spark):
    data = [(1, 1, None, None, 1, "t"), (2, 2, None, 1, 5, None), (2, 3, None, None, 5, None)]
    with pytest.raises(Exception):
        pr.pair_pages(posts(spark, data))
    assert paged(posts(spark, data), 10, strict=False) == [(1, "t", 0, [(2, 5)])]
    assert paged(posts(spark, []), 10) == []
    with pytest.raises(ValueError):
        pr.pair_pages(posts(spark, data), page_size=0)


def test_rank_of_a_group_over_many_partitions(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 4 > 0, 5).when(F.col("id") % 8 == 0, None).otherwise(F.col("id") % 3).alias("k"),
                                  F.col("id").alias("v"))
    got = rank_in_groups(df, ["k"], ["v"]).collect()
    want = {}
    for r in sorted(got, key=lambda r: r.v):
        assert r["rank"] == want.get(r.k, 0)
        want[r.k] = want.get(r.k, 0) + 1
    assert want[5] == 3000 and len(got) == 4000


def test_numbers_are_dense_and_ordered(spark):
    got = number_rows(spark.range(1000).select((F.lit(1000) - F.col("id")).alias("v")), ["v"], start=5).collect()
    assert sorted((r.n, r.v) for r in got) == [(5 + i, 1 + i) for i in range(1000)]
    weighed = number_rows(spark.range(100).select("id", (F.col("id") % 4).alias("w")), ["id"], weight="w").orderBy("id").collect()
    at = 0
    for r in weighed:
        assert r.n == at
        at += r.w


def test_strata_from_the_data(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 30 == 1, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 200).cast("string"))).alias("s"))
    got = vc.sample_strata(df, 4, ["s"], seed=3, out="n")
    found = got.collect()
    by = {}
    for r in sorted(found, key=lambda r: r.n):
        by.setdefault(r.s, []).append(r.n)
    sizes = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert {s: len(n) for s, n in by.items()} == {s: min(4, c) for s, c in sizes.items()}
    assert sorted(r.n for r in found) == list(range(len(found)))  # dense
    assert all(n == list(range(n[0], n[0] + len(n))) for n in by.values())  # a stratum's numbers lie together
    again = vc.sample_strata(df.repartition(7), 4, ["s"], seed=3, out="n").collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert sorted(map(str, vc.sample_strata(df, 4, ["s"], seed=4, out="n").collect())) != sorted(map(str, found))
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
