"""(tag, score) → integer points; seeded samples of points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.tags import tag_index
from tessera.operators.numbering import number_rows
from tessera.session import materialize

# The language list (index = position), spread between tags and k.
LANGS = ("JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
         "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy")
LANG_SPREAD = 50000
KMEANS_KERNELS = 45
SAMPLE_SEED = 42
# From this spread on the tags are far enough apart to stratify by.
STRATIFY_MIN_SPREAD = 500


def to_vectors(scored: DataFrame, tags: Sequence[str] = LANGS, *, spread: int = LANG_SPREAD,
               on_unknown: str = "error", id_col: str = "qid", tag_col: str = "tag",
               score_col: str = "score") -> DataFrame:
    """(id, x, y) with x = tag position * spread and y = score.

    A null or unlisted tag fails the job (``on_unknown='error'``) or drops the
    row (``'drop'``).
    """
    if spread <= 0:
        raise ValueError("spread must be positive so the tag can be recovered from x")
    if on_unknown not in ("error", "drop"):
        raise ValueError("on_unknown must be 'error' or 'drop'")
    idx = tag_index(tag_col, tags)
    if on_unknown == "error":
        idx = F.coalesce(idx, F.raise_error(F.concat(F.lit("tag not in list: "),
                                                      F.coalesce(F.col(tag_col), F.lit("null")))))
        src = scored
    else:
        src = scored.where(idx.isNotNull())
    return src.select(F.col(id_col).alias("id"), (idx * F.lit(spread)).cast("int").alias("x"),
                      F.col(score_col).cast("int").alias("y"))


def sample_key(id_col: str = "id", seed: int = SAMPLE_SEED) -> Column:
    """Seeded pseudo-random order: md5 of 'seed#id' (stable across runs and engines)."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(id_col).cast("string")))


def seed_centers(vectors: DataFrame, per_stratum: int, strata: Sequence[int], *, stratum: str = "x",
                 id_col: str = "id", seed: int = SAMPLE_SEED) -> DataFrame:
    """(id, x, y, cluster): ``per_stratum`` points drawn without replacement from each listed stratum.

    ``row_number() <= n`` plans a WindowGroupLimit before and after the
    exchange, so each task ships at most n rows per stratum: a stratum holding
    a third of all points costs no more than a small one. Clusters are numbered
    by (stratum, draw order), computed per row from the list of ``strata`` (the
    tag positions of k-means); points of other strata are not drawn. A stratum
    with fewer points gives all it has; ``initial_centers`` fails on it.
    """
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    strata = sorted(int(v) for v in strata)
    w = Window.partitionBy(stratum).orderBy(sample_key(id_col, seed), F.col(id_col))
    drawn = vectors.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_stratum)
    pos = F.array_position(F.array(*[F.lit(v) for v in strata]), F.col(stratum))
    cluster = (pos - 1) * F.lit(per_stratum) + F.col("_rn") - 1
    return drawn.where(pos > 0).select(id_col, "x", "y", cluster.cast("int").alias("cluster"))


def sample_strata(rows: DataFrame, per_stratum: int, strata: Sequence[str], *, id_col: str = "id", seed: int = SAMPLE_SEED,
                  out: str = "cluster") -> DataFrame:
    """``per_stratum`` rows without replacement of each stratum found in the data, and their dense numbers ``out``.

    The strata are whatever values the columns ``strata`` take (null is one), as
    many as there are. Each task keeps the ``per_stratum`` first rows of a
    stratum in the seeded order, and the shuffle merges these (the limit sits
    before and after the exchange), so a stratum with a third of all rows costs
    no more than a small one. Rows are numbered by (strata, draw order) without
    gaps: the strata's sizes, one row each, are numbered by range
    (``number_rows``), so neither the rows drawn nor the strata meet in one task.
    A stratum with fewer rows gives all it has.
    """
    if per_stratum <= 0:
        raise ValueError("per_stratum must be positive")
    keys = [f"__s{i}" for i in range(len(strata))]
    w = Window.partitionBy(*strata).orderBy(sample_key(id_col, seed), F.col(id_col))
    drawn = rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= per_stratum)
    drawn = materialize(drawn, "drawn")
    sizes = drawn.groupBy(*[F.col(s).alias(k) for s, k in zip(strata, keys, strict=True)]).agg(F.count(F.lit(1)).alias("__n"))
    firsts = number_rows(sizes, keys, weight="__n", out="__first")
    same = reduce(and_, (F.col(s).eqNullSafe(F.col(k)) for s, k in zip(strata, keys, strict=True)))
    number = F.col("__first") + F.col("__rn") - 1
    return drawn.join(firsts, same).select(*[F.col(f"`{c}`") for c in rows.columns], number.alias(out))


def tag_strata(tags: Sequence[str], spread: int) -> list[int]:
    """The x value of every tag: its position times the spread."""
    return [i * spread for i in range(len(tags))]


def plain_sample(vectors: DataFrame, n: int, *, id_col: str = "id", seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ``n`` points (or all if fewer) without replacement, seeded; no strata."""
    if n <= 0:
        raise ValueError("n must be positive")
    return vectors.orderBy(sample_key(id_col, seed), F.col(id_col)).limit(n)


def centers_per_stratum(k: int, n_strata: int) -> int:
    if n_strata <= 0 or k % n_strata != 0:
        raise ValueError(f"k={k} must be a positive multiple of the {n_strata} strata")
    return k // n_strata


def initial_centers(vectors: DataFrame, k: int = KMEANS_KERNELS, tags: Sequence[str] = LANGS, *,
                    spread: int = LANG_SPREAD, id_col: str = "id", seed: int = SAMPLE_SEED,
                    min_spread: int = STRATIFY_MIN_SPREAD) -> DataFrame:
    """(id, x, y, cluster): exactly k starting centers, as a local frame.

    With a spread of at least ``min_spread``, k / len(tags) points per tag (the
    stratum is x); below it, a plain seeded sample of k points. The draw runs
    here and k rows reach the driver; a tag with too few points, or fewer than
    k points in all, is an error.
    """
    if spread < min_spread:
        drawn = plain_sample(vectors, k, id_col=id_col, seed=seed).select(
            id_col, "x", "y", sample_key(id_col, seed).alias("_key"))
        rows = sorted(drawn.collect(), key=lambda r: (r["_key"], r[id_col]))
        found = [(*r[:3], i) for i, r in enumerate(rows)]
    else:
        drawn = seed_centers(vectors, centers_per_stratum(k, len(tags)), tag_strata(tags, spread), id_col=id_col, seed=seed)
        found = sorted((tuple(r) for r in drawn.collect()), key=lambda r: r[3])
    if len(found) != k:
        raise ValueError(f"drew {len(found)} of {k} centers: too few points" + (
            "" if spread < min_spread else f" of a tag (clusters found: {[r[3] for r in found]})"))
    id_type = vectors.schema[id_col].dataType.simpleString()
    return vectors.sparkSession.createDataFrame(found, f"`{id_col}` {id_type}, x int, y int, cluster int")
