"""One key holding a third of all rows: results stay whole and the plans split or pre-aggregate it."""

import contextlib

from pyspark.sql import functions as F

from tessera.operators import clusters as cl
from tessera.operators import lloyd as ll
from tessera.operators import pairs as pr
from tessera.operators import terms as tm
from tessera.operators import vectors as vc

N_ANSWERS = 30000
HOT = 7


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_posts(spark):
    """1000 questions; a third of the answers belong to question 7."""
    q = spark.range(1000).select(
        F.lit(1).alias("ptype"), F.col("id"), F.lit(None).cast("bigint").alias("accepted"),
        F.lit(None).cast("bigint").alias("parent"), F.lit(0).alias("score"), F.lit("Java").alias("tag"))
    a = spark.range(N_ANSWERS).select(
        F.lit(2).alias("ptype"), (F.col("id") + 10**6).alias("id"), F.lit(None).cast("bigint").alias("accepted"),
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 1000).alias("parent"),
        (F.col("id") % 50 - 20).cast("int").alias("score"), F.lit(None).cast("string").alias("tag"))
    return q.unionByName(a)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_hot_question_split_by_aqe(spark):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}):
        df = pr.pair_parent_child(hot_posts(spark))
        plan = final_plan(df)
        assert "SortMergeJoin(skew=true)" in plan
        assert df.count() == N_ANSWERS
        hot = df.where(F.col("qid") == HOT).count()
        assert hot == sum(1 for i in range(N_ANSWERS) if i % 3 == 0 or i % 1000 == HOT)


def test_best_score_hot_question(spark):
    df = pr.best_child_score(hot_posts(spark))
    got = {r["qid"]: r["score"] for r in df.collect()}
    assert len(got) == 1000
    assert got[HOT] == 29  # ids 0, 3, ... cover every residue mod 50
    plan = final_plan(df)
    assert "partial_max" in plan


def test_summary_hot_cluster_sizes_and_median(spark):
    # 90% of points in one cluster, many distinct scores.
    pts = spark.range(50000).select(
        F.when(F.col("id") % 10 == 0, F.lit(500000)).otherwise(F.lit(0)).cast("int").alias("x"),
        ((F.col("id") * 7919) % 100003 - 50000).cast("int").alias("y"))
    centers = [(0, 0), (500000, 0)]
    summary = cl.summarize_clusters(pts, centers, tags=tuple(f"t{i}" for i in range(11)), spread=50000)
    rows = {r["cluster"]: r for r in summary.collect()}
    assert sum(r["size"] for r in rows.values()) == 50000
    ys = sorted(r[0] for r in pts.where("x = 0").select("y").collect())
    n = len(ys)
    s = ys[(n - 1) // 2] + ys[n // 2]
    assert rows[0]["median"] == (abs(s) // 2) * (1 if s >= 0 else -1)
    assert rows[0]["label"] == "t0" and rows[0]["pct"] == 100.0


def test_seed_hot_stratum(spark):
    pts = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4 * 50000).cast("int").alias("x"),
        (F.col("id") % 97).cast("int").alias("y"))
    seeds = vc.seed_centers(pts, 5, sorted(r.x for r in pts.select("x").distinct().collect()))
    got = seeds.collect()
    per = {}
    for r in got:
        per[r["x"]] = per.get(r["x"], 0) + 1
    assert per == {0: 5, 50000: 5, 100000: 5, 150000: 5}
    assert "WindowGroupLimit" in final_plan(seeds)


def test_hot_term_counts(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot word")).otherwise(F.concat(F.lit("w"), (F.col("id") % 50).cast("string")))
        .alias("text"))
    got = {r["term"]: r["n_docs"] for r in tm.rank_terms(docs, ["hot", "w1", "none"]).collect()}
    assert got == {"hot": 3000, "w1": 120, "none": 0}


def test_lloyd_hot_cluster_matches_unweighted(spark):
    pts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5 * 50000).cast("int").alias("x"),
        (F.col("id") % 31 - 10).cast("int").alias("y"))
    seeds = [(0, 0), (0, 10), (100000, 5), (200000, 0)]
    a, _ = ll.fit_lloyd(pts, seeds, eta=0.0, max_iter=4)
    b, _ = ll.fit_lloyd(pts, seeds, eta=0.0, max_iter=4, fold=False)
    assert a == b
