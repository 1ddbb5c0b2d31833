"""Time the whole clustering run at the size of the published figure.

About 2.1 million (tag, score) points, k = 45, eta 20, at most 45 passes, two
cores: the question vectors of the given tables, each with the same tag at
``COPIES`` shifted scores. Seeds, Lloyd passes and the cluster report are timed
together, from reading the tables on.

Usage: python tools/bench_clustering.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import clusters as cl  # noqa: E402
from tessera.operators import lloyd as ll  # noqa: E402
from tessera.operators import pairs as pr  # noqa: E402
from tessera.operators import vectors as vc  # noqa: E402
from tessera.plans import bindings as b  # noqa: E402
from tessera.session import build_session, clear_scratch  # noqa: E402

COPIES = 14


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '2')}]", shuffle_partitions=8)
    spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count().collect()  # starts the engine
    t0 = time.perf_counter()
    scored = pr.best_child_score(b.posts_frame(spark, sf_dir))
    points = vc.to_vectors(scored, b.ORDER_TAGS, spread=b.SPREAD).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))).select(
        (F.col("id") * COPIES + F.col("copy")).alias("id"), "x",
        (F.col("y") + F.col("copy") * F.pmod(F.hash("id"), F.lit(97))).cast("int").alias("y"))
    points = ll.materialize(points, "bench-points")
    n = points.count()
    seeds = vc.initial_centers(points, 45, b.ORDER_TAGS, spread=b.SPREAD)
    means, trace = ll.fit_lloyd(points, ll.collect_centers(seeds, 45))
    lines = cl.cluster_report(cl.summarize_clusters(points, means, b.ORDER_TAGS, spread=b.SPREAD)).collect()
    took = time.perf_counter() - t0
    print({"points": n, "k": 45, "passes": trace[-1]["iteration"], "clusters": len(lines), "seconds": round(took, 1)})
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
