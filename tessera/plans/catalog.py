"""Query catalogue: each entry runs operators on the bound tables; each oracle is DuckDB SQL.

Column names of every query equal those of its oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sql import class_sum_sql, register_sql
from tessera.operators import bounds as bd
from tessera.operators import bucketed as bk
from tessera.operators import clusters as cl
from tessera.operators import lloyd as ll
from tessera.operators import membership as mb
from tessera.operators import pairs as pr
from tessera.operators import postings as po
from tessera.operators import survey as sv
from tessera.operators import vectors as vc
from tessera.operators import terms as tm
from tessera.plans import bindings as b
from tessera.session import scratch_path
from tessera.sources.aside import Loaded, set_aside
from tessera.sources.markup import extract_marked, mark_marked
from tessera.sources.text import format_posts, load_posts, read_posts
from tessera.sources.widecsv import load_wide_csv, read_wide_csv, write_wide_csv
from tessera import streaming as st

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- survey

def _survey_summary(spark: SparkSession, sf_dir: str, *, exclude_unemployable: bool = False) -> DataFrame:
    df = b.survey_frame(spark, sf_dir)
    p, w, o = sv.classify_columns(df.columns)
    return sv.summarize_time(df, p, w, o, exclude_unemployable=exclude_unemployable)


def survey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_summary(spark, sf_dir)


def survey_summary_employable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_summary(spark, sf_dir, exclude_unemployable=True)


def survey_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.average_by_group(_survey_summary(spark, sf_dir))


def survey_grouped_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.average_by_group_sql(_survey_summary(spark, sf_dir))


def survey_grouped_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.average_by_group_typed(_survey_summary(spark, sf_dir))


def survey_wide_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped means over as many activity columns as a time-use file has."""
    df = b.wide_survey_frame(spark, sf_dir)
    p, w, o = sv.classify_columns(df.columns)
    return sv.average_by_group(sv.summarize_time(df, p, w, o))


def _survey_wide_sql() -> str:
    p, w, o = sv.classify_columns([n for n, _, _ in b.WIDE_ACTIVITIES])
    by_name = {n: f"({c} * {f})" for n, c, f in b.WIDE_ACTIVITIES}

    def hours(names: list[str]) -> str:
        return "(" + " + ".join(by_name[n] for n in names) + ") / 60.0"

    return f"""
WITH summary AS (
  SELECT CASE WHEN l_linenumber >= 1 AND l_linenumber < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN l_suppkey % 2 + 1 = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN l_partkey % 90 BETWEEN 15 AND 22 THEN 'young' WHEN l_partkey % 90 > 55 THEN 'elder' ELSE 'active' END AS age,
         {hours(p)} AS "primaryNeeds", {hours(w)} AS work, {hours(o)} AS other
  FROM lineitem)
SELECT working, sex, age, round(avg("primaryNeeds"), 1) AS "primaryNeeds", round(avg(work), 1) AS work,
       round(avg(other), 1) AS other
FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"""


_SURVEY_CTE = """
WITH survey AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tucaseid,
         CAST(l_linenumber AS DOUBLE) AS telfs,
         CAST(l_suppkey % 2 + 1 AS DOUBLE) AS tesex,
         CAST(l_partkey % 90 AS DOUBLE) AS teage,
         l_quantity AS t010101,
         l_tax * 100 AS t030101,
         l_discount * 100 AS t050101,
         l_extendedprice / 1000 AS t180501,
         l_quantity * 2 AS t020101,
         l_tax * 50 AS t180101,
         l_discount * 10 AS t180901,
         l_quantity * 7 AS t170101
  FROM lineitem
), summary AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage BETWEEN 15 AND 22 THEN 'young'
              WHEN teage > 55 AND NOT isnan(teage) THEN 'elder' ELSE 'active' END AS age,
         (t010101 + t030101 + t180101) / 60.0 AS "primaryNeeds",
         (t050101 + t180501) / 60.0 AS work,
         (t020101 + t180901) / 60.0 AS other,
         telfs
  FROM survey
)"""

_SURVEY_GROUPED_SQL = _SURVEY_CTE + """
SELECT working, sex, age,
       round(avg("primaryNeeds"), 1) AS "primaryNeeds",
       round(avg(work), 1) AS work,
       round(avg(other), 1) AS other
FROM summary GROUP BY working, sex, age ORDER BY working, sex, age
"""


# --------------------------------------------------------------------------- terms and pages

def term_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.mention_count(b.docs_frame(spark, sf_dir), b.DOC_TERMS[0])


def term_rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.rank_terms(b.docs_frame(spark, sf_dir), b.DOC_TERMS, keep_zero=True)


def term_rank_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking with the term list as a joined table."""
    return tm.rank_terms(b.docs_frame(spark, sf_dir), b.DOC_TERMS, by_join=True)


def term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.build_index(b.docs_frame(spark, sf_dir), b.DOC_TERMS)


def term_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.rank_from_index(term_index(spark, sf_dir))


def _index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.build_index_pages(b.docs_frame(spark, sf_dir), b.DOC_TERMS, page_size=b.INDEX_PAGE)


def term_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested index: one sorted id list per term and page (shown as text)."""
    return _index_pages(spark, sf_dir).select(
        "term", "page", F.array_join(F.transform("doc_ids", lambda i: i.cast("string")), " ").alias("doc_ids"))


def term_rank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.rank_from_index(_index_pages(spark, sf_dir), pages=True)


def term_rank_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.rank_terms(b.docs_frame(spark, sf_dir), b.DOC_TERMS, keep_zero=False)


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_marked(b.pages_frame(spark, sf_dir), "html", start_marker="<title>",
                          marker="</title>", suffix_len=0, keep=("page_id",))


def article_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in the one-line layout (14 characters, title, marker, text, 16 characters), taken apart."""
    return extract_marked(b.article_lines(spark, sf_dir), keep=("doc_id",))


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


_TERMS_CTE = ("WITH terms(ord, term) AS (VALUES "
              + ", ".join(f"({i}, {_sql_str(t)})" for i, t in enumerate(b.DOC_TERMS)) + "),\n"
              "postings AS (SELECT t.term, d.doc_id FROM documents d JOIN terms t "
              "ON list_contains(string_split(d.text, ' '), t.term))\n")

_TERMS_RANK_SQL = _TERMS_CTE + "SELECT term, count(*) AS n_docs FROM postings GROUP BY term ORDER BY n_docs DESC, term"

_TERMS_ORACLE = {
    "term_mentions": f"SELECT {_sql_str(b.DOC_TERMS[0])} AS term, count(*) AS n_docs FROM documents "
                     f"WHERE list_contains(string_split(text, ' '), {_sql_str(b.DOC_TERMS[0])})",
    "term_rank_all": _TERMS_CTE + """
SELECT t.term, coalesce(h.n, 0)::BIGINT AS n_docs
FROM terms t LEFT JOIN (SELECT term, count(*) AS n FROM postings GROUP BY term) h USING (term)
ORDER BY n_docs DESC, t.ord""",
    "term_rank_join": _TERMS_CTE + """
SELECT t.term, coalesce(h.n, 0)::BIGINT AS n_docs
FROM terms t LEFT JOIN (SELECT term, count(*) AS n FROM postings GROUP BY term) h USING (term)
ORDER BY n_docs DESC, t.ord""",
    "term_index": _TERMS_CTE + "SELECT term, doc_id FROM postings",
    "term_rank_index": _TERMS_RANK_SQL,
    "term_rank_pages": _TERMS_RANK_SQL,
    "term_index_pages": _TERMS_CTE + f"""
SELECT term, CAST(floor(doc_id / {b.INDEX_PAGE}) AS BIGINT) AS page,
       string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS doc_ids
FROM postings GROUP BY term, page""",
    "term_rank_fused": _TERMS_RANK_SQL,
    "article_titles": "SELECT doc_id, 'Article ' || CAST(doc_id AS VARCHAR) AS title, text FROM documents",
    "page_titles": """
SELECT page_id,
       substring(html, strpos(html, '<title>') + 7, strpos(html, '</title>') - (strpos(html, '<title>') + 7)) AS title,
       substring(html, strpos(html, '</title>') + 8, length(html) - (strpos(html, '</title>') + 8) + 1) AS text
FROM pages""",
}

# --------------------------------------------------------------------------- Q/A clustering

def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.pair_parent_child(b.posts_frame(spark, sf_dir))


def qa_best_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.best_child_score(b.posts_frame(spark, sf_dir, score_shift=b.SCORE_SHIFT))


def qa_best_score_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.best_child_score(b.posts_frame(spark, sf_dir, score_shift=b.SCORE_SHIFT), floor=0)


def _qa_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pr.best_child_score(b.posts_frame(spark, sf_dir))
    return vc.to_vectors(scored, b.ORDER_TAGS, spread=b.SPREAD)


def qa_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qa_vectors(spark, sf_dir)


def qa_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vc.seed_centers(_qa_vectors(spark, sf_dir), b.PER_TAG, vc.tag_strata(b.ORDER_TAGS, b.SPREAD), seed=b.SEED)


def qa_plain_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vc.plain_sample(_qa_vectors(spark, sf_dir), b.PER_TAG * len(b.ORDER_TAGS), seed=b.SEED)


def _seeded(spark: SparkSession, sf_dir: str, per_tag: int = b.PER_TAG) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Vectors and the histogram of their points, both written once; seeds drawn from the vectors.

    Seeding reads the vectors (it needs the ids); the passes and the summary
    read the small histogram. Writing both to the shared folder means no job
    re-runs scan + join + max, and a lost executor replays nothing upstream.
    """
    vectors = ll.materialize(_qa_vectors(spark, sf_dir), "qa-vectors")
    k = per_tag * len(b.ORDER_TAGS)
    # The histogram and the seeds are independent jobs over the written
    # vectors: submitted from two threads, Spark runs them side by side.
    with ThreadPoolExecutor(max_workers=2) as pool:
        hist = pool.submit(ll.materialize, ll.point_histogram(vectors), "qa-hist")
        seeds = pool.submit(ll.collect_centers,
                            vc.initial_centers(vectors, k, b.ORDER_TAGS, spread=b.SPREAD, seed=b.SEED),
                            expected=k)
        return hist.result(), seeds.result()


def _fit(hist: DataFrame, seeds: list[tuple[int, int]], eta: float, max_iter: int):
    return ll.fit_lloyd(hist, seeds, eta=eta, max_iter=max_iter, weight="w", cut_lineage=False)


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, seeds = _seeded(spark, sf_dir)
    return ll.centers_frame(spark, ll.lloyd_update(hist, seeds, weight="w"))


def lloyd_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, seeds = _seeded(spark, sf_dir)
    means, _ = _fit(hist, seeds, 0.0, 3)
    return ll.centers_frame(spark, means)


def lloyd_fit_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, seeds = _seeded(spark, sf_dir)
    means, _ = _fit(hist, seeds, ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
    return ll.centers_frame(spark, means)


def lloyd_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, seeds = _seeded(spark, sf_dir)
    _, history = _fit(hist, seeds, ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
    return ll.history_frame(spark, history)


def _one_step_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist, seeds = _seeded(spark, sf_dir)
    return cl.summarize_clusters(hist, ll.lloyd_update(hist, seeds, weight="w"), b.ORDER_TAGS, spread=b.SPREAD, weight="w")


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_step_summary(spark, sf_dir)


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cluster_report(_one_step_summary(spark, sf_dir))


def cluster_summary_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole clustering run: seeds → Lloyd until converged → cluster summary."""
    hist, seeds = _seeded(spark, sf_dir)
    means, _ = _fit(hist, seeds, ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
    return cl.summarize_clusters(hist, means, b.ORDER_TAGS, spread=b.SPREAD, weight="w")


def cluster_report_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the run with the published number of centers: k = 45, nine per tag."""
    hist, seeds = _seeded(spark, sf_dir, b.PER_TAG_PUBLISHED)
    means, _ = _fit(hist, seeds, ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
    return cl.cluster_report(cl.summarize_clusters(hist, means, b.ORDER_TAGS, spread=b.SPREAD, weight="w"))


def cluster_report_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report lines of the whole clustering run."""
    return cl.cluster_report(cluster_summary_converged(spark, sf_dir))


def _tags_sql() -> str:
    return "[" + ", ".join(_sql_str(t) for t in b.ORDER_TAGS) + "]"


def _posts_cte(shift: int = 0, *, recursive: bool = False, per_tag: int = b.PER_TAG) -> str:
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"""{head} q AS (SELECT o_orderkey AS id, o_orderpriority AS tag FROM orders),
a AS (SELECT l_orderkey AS parent, l_orderkey * 10 + l_linenumber AS aid,
             CAST(trunc(l_quantity) AS INTEGER) - {shift} AS score FROM lineitem),
best AS (SELECT parent, max(score) AS score FROM a GROUP BY parent),
vectors AS (SELECT q.id, CAST((list_position({_tags_sql()}, q.tag) - 1) * {b.SPREAD} AS INTEGER) AS x,
                   best.score AS y
            FROM q JOIN best ON q.id = best.parent),
ranked AS (SELECT id, x, y, row_number() OVER (PARTITION BY x ORDER BY md5('{b.SEED}#' || CAST(id AS VARCHAR)), id) AS rn
           FROM vectors),
m0 AS (SELECT CAST(row_number() OVER (ORDER BY x, rn) - 1 AS INTEGER) AS cluster, id, x, y
       FROM ranked WHERE rn <= {per_tag})"""


def _step_sql(src: str, dst: str) -> str:
    """CTEs assigning vectors to the centers of ``src`` and averaging into ``dst``."""
    return f""",
a_{src} AS (SELECT v.x, v.y, arg_min(c.cluster, (
              (CAST(v.x AS DOUBLE) - c.x) * (CAST(v.x AS DOUBLE) - c.x)
            + (CAST(v.y AS DOUBLE) - c.y) * (CAST(v.y AS DOUBLE) - c.y), c.cluster)) AS cluster
          FROM vectors v, {src} c GROUP BY v.id, v.x, v.y),
u_{src} AS (SELECT cluster, CAST(sum(CAST(x AS BIGINT)) // count(*) AS INTEGER) AS x,
                   CAST(sum(CAST(y AS BIGINT)) // count(*) AS INTEGER) AS y
          FROM a_{src} GROUP BY cluster),
{dst} AS (SELECT c.cluster, coalesce(u.x, c.x) AS x, coalesce(u.y, c.y) AS y
        FROM {src} c LEFT JOIN u_{src} u USING (cluster))"""


def _fit_sql(eta: float, max_iter: int) -> str:
    """Recursive CTE ``fit``: one level per Lloyd pass, stopping like ``fit_lloyd``.

    Pass k runs when k <= max_iter and pass k-1 moved the centers by at least
    eta (level 0 holds the seeds with an infinite move). Each level keeps the
    old and new center and the pass's total squared move; ``fit_final`` is the
    last level.
    """
    return f""",
fit(iter, cluster, x, y, old_x, old_y, total) AS (
  SELECT 0, cluster, x, y, x, y, CAST('inf' AS DOUBLE) FROM m0
  UNION ALL
  SELECT iter + 1, cluster, nx, ny, x, y,
         sum((CAST(nx AS DOUBLE) - x) * (nx - x) + (CAST(ny AS DOUBLE) - y) * (ny - y)) OVER ()
  FROM (
    SELECT iter, cluster, x, y,
           CASE WHEN n > 0 THEN CAST(sx // n AS INTEGER) ELSE x END AS nx,
           CASE WHEN n > 0 THEN CAST(sy // n AS INTEGER) ELSE y END AS ny
    FROM (
      SELECT iter, cluster, x, y,
             count(*) FILTER (WHERE near = cluster) AS n,
             sum(CAST(px AS BIGINT)) FILTER (WHERE near = cluster) AS sx,
             sum(CAST(py AS BIGINT)) FILTER (WHERE near = cluster) AS sy
      FROM (
        SELECT c.iter, c.cluster, c.x, c.y, v.x AS px, v.y AS py,
               arg_min(c.cluster, ((CAST(v.x AS DOUBLE) - c.x) * (CAST(v.x AS DOUBLE) - c.x)
                                 + (CAST(v.y AS DOUBLE) - c.y) * (CAST(v.y AS DOUBLE) - c.y), c.cluster))
                 OVER (PARTITION BY v.id) AS near
        FROM fit c, vectors v
        WHERE c.iter < {max_iter} AND c.total >= {float(eta)!r}
      ) j
      GROUP BY iter, cluster, x, y
    ) g
  ) u
),
fit_final AS (SELECT cluster, x, y FROM fit WHERE iter = (SELECT max(iter) FROM fit))"""


def _summary_sql(means: str) -> str:
    return f""",
fin AS (SELECT v.x, v.y, arg_min(c.cluster, (
              (CAST(v.x AS DOUBLE) - c.x) * (CAST(v.x AS DOUBLE) - c.x)
            + (CAST(v.y AS DOUBLE) - c.y) * (CAST(v.y AS DOUBLE) - c.y), c.cluster)) AS cluster
        FROM vectors v, {means} c GROUP BY v.id, v.x, v.y),
per_x AS (SELECT cluster, x, count(*) AS n FROM fin GROUP BY cluster, x),
top AS (SELECT cluster, arg_max(x, (n, -x)) AS top_x, max(n) AS top_n FROM per_x GROUP BY cluster),
stats AS (SELECT cluster, count(*) AS size, CAST(trunc(quantile_cont(y, 0.5)) AS INTEGER) AS median
          FROM fin GROUP BY cluster),
summary AS (SELECT s.cluster, {_tags_sql()}[top_x // {b.SPREAD} + 1] AS label,
                   CAST(top_n * 100 // size AS DOUBLE) AS pct, size, median
            FROM stats s JOIN top t USING (cluster))
"""


_QA_ORACLE = {
    "qa_pairs": """
SELECT o.o_orderkey AS qid, o.o_orderpriority AS tag, l.l_orderkey * 10 + l.l_linenumber AS aid,
       CAST(trunc(l.l_quantity) AS INTEGER) AS score
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "qa_best_score": _posts_cte(b.SCORE_SHIFT) + """
SELECT q.id AS qid, q.tag, best.score FROM q JOIN best ON q.id = best.parent""",
    "qa_best_score_floor": _posts_cte(b.SCORE_SHIFT) + """
SELECT q.id AS qid, q.tag, greatest(0, best.score) AS score FROM q JOIN best ON q.id = best.parent""",
    "qa_vectors": _posts_cte() + "\nSELECT id, x, y FROM vectors",
    "qa_seed": _posts_cte() + "\nSELECT id, x, y, cluster FROM m0",
    "qa_plain_sample": _posts_cte() + f"""
SELECT id, x, y FROM vectors ORDER BY md5('{b.SEED}#' || CAST(id AS VARCHAR)), id
LIMIT {b.PER_TAG * len(b.ORDER_TAGS)}""",
    "lloyd_step": _posts_cte() + _step_sql("m0", "m1") + "\nSELECT cluster, x, y FROM m1",
    "lloyd_fit": _posts_cte() + _step_sql("m0", "m1") + _step_sql("m1", "m2") + _step_sql("m2", "m3")
                 + "\nSELECT cluster, x, y FROM m3",
    "lloyd_fit_converged": _posts_cte(recursive=True) + _fit_sql(ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
                           + "\nSELECT cluster, x, y FROM fit_final",
    "lloyd_history": _posts_cte(recursive=True) + _fit_sql(ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS) + """
SELECT CAST(iter AS INTEGER) AS iteration, cluster, old_x, old_y, x AS new_x, y AS new_y,
       (CAST(old_x AS DOUBLE) - x) * (old_x - x) + (CAST(old_y AS DOUBLE) - y) * (old_y - y) AS moved,
       total AS total_moved
FROM fit WHERE iter >= 1""",
    "cluster_summary_converged": _posts_cte(recursive=True) + _fit_sql(ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
                                 + _summary_sql("fit_final")
                                 + "SELECT cluster, label, pct, size, median FROM summary ORDER BY median, cluster",
    "cluster_summary": _posts_cte() + _step_sql("m0", "m1") + _summary_sql("m1")
                       + "SELECT cluster, label, pct, size, median FROM summary ORDER BY median, cluster",
    "cluster_report_converged": _posts_cte(recursive=True) + _fit_sql(ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS)
                                + _summary_sql("fit_final")
                                + f"SELECT cluster, printf('{cl.REPORT_FORMAT}', median, label, pct, size) AS line "
                                  "FROM summary ORDER BY median, cluster",
    "cluster_report_published": _posts_cte(recursive=True, per_tag=b.PER_TAG_PUBLISHED)
                                + _fit_sql(ll.KMEANS_ETA, ll.KMEANS_MAX_ITERATIONS) + _summary_sql("fit_final")
                                + f"SELECT cluster, printf('{cl.REPORT_FORMAT}', median, label, pct, size) AS line "
                                  "FROM summary ORDER BY median, cluster",
    "cluster_report": _posts_cte() + _step_sql("m0", "m1") + _summary_sql("m1")
                      + f"SELECT cluster, printf('{cl.REPORT_FORMAT}', median, label, pct, size) AS line "
                        "FROM summary ORDER BY median, cluster",
}

# --------------------------------------------------------------------------- file sources

def posts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts written as header-less text lines to the shared scratch folder, parsed back."""
    path = scratch_path(spark, "posts-text")
    format_posts(b.posts_frame(spark, sf_dir)).write.text(path)
    return read_posts(spark, path)


def _survey_csv(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    path = scratch_path(spark, "survey-csv")
    write_wide_csv(b.survey_frame(spark, sf_dir), path)
    return read_wide_csv(spark, path)


def wide_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey written as a wide CSV with header, read back with a header-derived schema."""
    return _survey_csv(spark, sf_dir)[1]


def wide_csv_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole time-use flow from a CSV file: header → classes → summary → grouped means."""
    names, df = _survey_csv(spark, sf_dir)
    p, w, o = sv.classify_columns(names)
    return sv.average_by_group(sv.summarize_time(df, p, w, o))


_SOURCES_ORACLE = {
    "posts_roundtrip": """
SELECT 1 AS ptype, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted, CAST(NULL AS BIGINT) AS parent,
       0 AS score, o_orderpriority AS tag FROM orders
UNION ALL
SELECT 2, l_orderkey * 10 + l_linenumber, NULL, l_orderkey, CAST(trunc(l_quantity) AS INTEGER), NULL
FROM lineitem""",
    "wide_csv_roundtrip": _SURVEY_CTE + "\nSELECT * FROM survey",
    "wide_csv_grouped": _SURVEY_GROUPED_SQL,
}

# --------------------------------------------------------------------------- nested pairs, samples, bounded and resumed fits

def _answer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.pair_pages(b.posts_frame(spark, sf_dir, score_shift=b.SCORE_SHIFT), page_size=b.ANSWER_PAGE)


def qa_pair_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with pages of their answers (shown as text)."""
    shown = F.transform("answers", lambda a: F.concat_ws(":", a["aid"].cast("string"), a["score"].cast("string")))
    return _answer_pages(spark, sf_dir).select("qid", "tag", "page", F.array_join(shown, " ").alias("answers"))


def qa_best_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.best_score_of_pages(_answer_pages(spark, sf_dir), floor=0)


def qa_seed_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds per tag, the tags found in the data."""
    return vc.sample_strata(_qa_vectors(spark, sf_dir), b.PER_TAG, ["x"], seed=b.SEED)


def line_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of every supplier and return flag there is."""
    lines = b.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), "l_suppkey", "l_returnflag")
    return vc.sample_strata(lines, b.PER_SUPPLIER, ["l_suppkey", "l_returnflag"], seed=b.SEED, out="n")


def _line_seeds(points: DataFrame) -> list[tuple[int, int]]:
    return ll.collect_centers(vc.initial_centers(points, b.MANY_CENTERS, spread=1, seed=b.SEED), expected=b.MANY_CENTERS)


def lloyd_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three passes with hundreds of centers, most distances saved by bounds."""
    points = b.line_points(spark, sf_dir)
    means, _, _ = bd.fit_lloyd_bounded(points, _line_seeds(points), eta=0.0, max_iter=3)
    return ll.centers_frame(spark, means)


def lloyd_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trace of a fit that stopped after two passes and went on from its folder."""
    hist, seeds = _seeded(spark, sf_dir)
    state = scratch_path(spark, "lloyd-state")
    ll.fit_lloyd(hist, seeds, max_iter=2, weight="w", state=state)
    _, history = ll.resume_lloyd(spark, state)
    return ll.history_frame(spark, history)


_LINE_POINTS_CTE = f"""WITH vectors AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, CAST(trunc(l_quantity) * 100 + l_suppkey % 100 AS INTEGER) AS x,
         CAST(trunc(l_extendedprice) AS INTEGER) AS y FROM lineitem),
m0 AS (SELECT CAST(row_number() OVER (ORDER BY md5('{b.SEED}#' || CAST(id AS VARCHAR)), id) - 1 AS INTEGER) AS cluster, x, y
       FROM vectors ORDER BY cluster LIMIT {b.MANY_CENTERS})"""

_MORE_ORACLE = {
    "qa_pair_pages": _posts_cte(b.SCORE_SHIFT) + f""",
paged AS (SELECT *, (row_number() OVER (PARTITION BY parent ORDER BY aid, score) - 1) // {b.ANSWER_PAGE} AS page FROM a)
SELECT q.id AS qid, q.tag, page, string_agg(aid || ':' || score, ' ' ORDER BY aid, score) AS answers
FROM paged JOIN q ON q.id = paged.parent GROUP BY q.id, q.tag, page""",
    "qa_best_of_pages": _QA_ORACLE["qa_best_score_floor"],
    "qa_seed_found": _posts_cte() + "\nSELECT id, x, y, CAST(cluster AS BIGINT) AS cluster FROM m0",
    "line_sample": f"""
WITH l AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS id, l_suppkey, l_returnflag FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY md5('{b.SEED}#' || CAST(id AS VARCHAR)), id) AS rn FROM l)
SELECT id, l_suppkey, l_returnflag, row_number() OVER (ORDER BY l_suppkey, l_returnflag, rn) - 1 AS n FROM r WHERE rn <= {b.PER_SUPPLIER}""",
    "lloyd_bounded": _LINE_POINTS_CTE + _step_sql("m0", "m1") + _step_sql("m1", "m2") + _step_sql("m2", "m3")
                     + "\nSELECT cluster, x, y FROM m3",
    "lloyd_resumed": _QA_ORACLE["lloyd_history"],
}

# --------------------------------------------------------------------------- bad rows aside

def _posts_loaded(spark: SparkSession, sf_dir: str) -> Loaded:
    path = scratch_path(spark, "faulty-posts")
    b.faulty_post_lines(spark, sf_dir).write.text(path)
    return load_posts(spark, path, scratch_path(spark, "posts-loaded"))


def posts_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of files with bad lines in them."""
    return _posts_loaded(spark, sf_dir).good


def posts_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines put aside, and why."""
    return _posts_loaded(spark, sf_dir).bad.select("raw", "reason")


def _survey_loaded(spark: SparkSession, sf_dir: str) -> Loaded:
    path = scratch_path(spark, "faulty-survey")
    b.write_faulty_survey(spark, sf_dir, path)
    return load_wide_csv(spark, path, scratch_path(spark, "survey-loaded"))[1]


def wide_csv_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_loaded(spark, sf_dir).good


def wide_csv_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_loaded(spark, sf_dir).bad.select("raw", "reason")


def _articles_loaded(spark: SparkSession, sf_dir: str) -> Loaded:
    return set_aside(mark_marked(b.faulty_article_lines(spark, sf_dir), keep=("doc_id",)), scratch_path(spark, "articles-loaded"))


def articles_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles_loaded(spark, sf_dir).good


def articles_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles_loaded(spark, sf_dir).bad


def _faulty_survey_sql() -> str:
    columns = ", ".join(f"{e.replace(' as string', ' AS VARCHAR').replace('cast(l_quantity as int)', 'CAST(trunc(l_quantity) AS INTEGER)')} AS {n}"
                        for n, e in b.FAULTY_COLUMNS)
    return f"WITH f AS (SELECT l_orderkey % 40 AS fault, {columns} FROM lineitem)"


def _joined(names: list[str]) -> str:
    return " || ',' || ".join(names)


_FAULTY_NAMES = [n for n, _ in b.FAULTY_COLUMNS]
_ARTICLE_SQL = "'<page> <title>' || 'Article ' || CAST(doc_id AS VARCHAR) || '</title><text>'"

_ASIDE_ORACLE = {
    "posts_good": f"SELECT * FROM ({_SOURCES_ORACLE['posts_roundtrip']}) WHERE id % 50 NOT IN (1, 2, 3)",
    "posts_bad": f"""
SELECT CASE id % 50 WHEN 1 THEN ptype || ',' || id
         ELSE ptype || ',' || id || CASE id % 50 WHEN 3 THEN ',z' ELSE ',' END || ',' || coalesce(CAST(parent AS VARCHAR), '') || ','
              || CASE id % 50 WHEN 2 THEN 'x' ELSE CAST(score AS VARCHAR) END || ',' || coalesce(tag, '') END AS raw,
       CASE id % 50 WHEN 1 THEN 'fewer than 5 fields' WHEN 2 THEN 'bad number: score' ELSE 'bad number: accepted' END AS reason
FROM ({_SOURCES_ORACLE['posts_roundtrip']}) WHERE id % 50 IN (1, 2, 3)""",
    "wide_csv_good": _faulty_survey_sql() + f"""
SELECT tucaseid, {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in _FAULTY_NAMES[1:])} FROM f WHERE fault NOT BETWEEN 1 AND 5""",
    "wide_csv_bad": _faulty_survey_sql() + f"""
SELECT CASE fault WHEN 1 THEN {_joined(_FAULTY_NAMES[:-1])} WHEN 2 THEN {_joined(_FAULTY_NAMES)} || ',7'
         WHEN 3 THEN {_joined([*_FAULTY_NAMES[:3], "''", *_FAULTY_NAMES[4:]])}
         WHEN 4 THEN {_joined([*_FAULTY_NAMES[:5], "'abc'", *_FAULTY_NAMES[6:]])} ELSE '{",".join(_FAULTY_NAMES)}' END AS raw,
       CASE WHEN fault <= 2 THEN 'not {len(_FAULTY_NAMES)} fields' ELSE 'bad or empty number: ' ||
         CASE fault WHEN 3 THEN '{_FAULTY_NAMES[3]}' WHEN 4 THEN '{_FAULTY_NAMES[5]}' ELSE '{_FAULTY_NAMES[1]}' END END AS reason
FROM f WHERE fault BETWEEN 1 AND 5""",
    "articles_good": "SELECT doc_id, 'Article ' || CAST(doc_id AS VARCHAR) AS title, text FROM documents WHERE doc_id % 20 NOT IN (1, 2)",
    "articles_bad": f"""
SELECT CASE doc_id % 20 WHEN 1 THEN replace({_ARTICLE_SQL} || text || '</text>  </page>', '</title>', '') ELSE {_ARTICLE_SQL} || 'cut' END AS raw,
       CASE doc_id % 20 WHEN 1 THEN 'no marker' ELSE 'too short' END AS reason
FROM documents WHERE doc_id % 20 IN (1, 2)""",
}

# --------------------------------------------------------------------------- blocks, long lists, buckets, SQL text

def _term_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = po.build_blocks(term_index(spark, sf_dir), block_size=b.INDEX_BLOCK, page_size=b.INDEX_PAGE)
    path = scratch_path(spark, "term-blocks")
    blocks.write.parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def term_index_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index in delta-coded blocks (the gaps shown as text)."""
    return _term_blocks(spark, sf_dir).withColumn("deltas", F.array_join("deltas", " "))


def term_rank_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking from the blocks' headers."""
    return po.rank_from_blocks(_term_blocks(spark, sf_dir))


def term_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with both of two terms, by blocks that overlap."""
    return po.intersect_terms(_term_blocks(spark, sf_dir), *b.TWO_TERMS)


def term_rank_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking of every token of the benchmark, as a table of terms."""
    return mb.rank_term_table(b.docs_frame(spark, sf_dir), b.benchmark_tokens(spark, sf_dir))


def _bucketed(spark: SparkSession, sf_dir: str) -> bk.PostTables:
    path = scratch_path(spark, "bucketed")
    name = "posts_" + path.rstrip("/").rsplit("/", 1)[1].replace("-", "_")
    return bk.write_bucketed(b.posts_frame(spark, sf_dir, score_shift=b.SCORE_SHIFT), name, path, buckets=b.BUCKETS)


def qa_pairs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs from tables bucketed by question."""
    return bk.bucketed_pairs(spark, _bucketed(spark, sf_dir))


def qa_best_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk.bucketed_best_score(spark, _bucketed(spark, sf_dir), floor=0)


def survey_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole survey as one SQL text with the library's SQL functions."""
    register_sql(spark)
    df = b.survey_frame(spark, sf_dir)
    primary, work, other = (class_sum_sql(c) for c in sv.classify_columns(df.columns))
    return spark.sql(f"""
SELECT ts_working_band(telfs) AS working, ts_sex_band(tesex) AS sex, ts_age_band(teage) AS age,
       round(avg(ts_minutes_to_hours({primary})), 1) AS primaryNeeds, round(avg(ts_minutes_to_hours({work})), 1) AS work,
       round(avg(ts_minutes_to_hours({other})), 1) AS other
FROM {{survey}} GROUP BY ALL ORDER BY working, sex, age""", survey=df)


def term_rank_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking as SQL text with a table function."""
    register_sql(spark)
    return spark.sql("""
SELECT t.term, count(*) AS n_docs FROM {docs} d, LATERAL ts_terms_of(d.text, :terms) t GROUP BY t.term ORDER BY n_docs DESC, t.term""",
                     args={"terms": F.array(*[F.lit(t) for t in b.DOC_TERMS])}, docs=b.docs_frame(spark, sf_dir))


_BLOCK_ORACLE = {
    "term_index_blocks": f"""
WITH p AS (SELECT *, doc_id // {b.INDEX_PAGE} AS page FROM ({_TERMS_ORACLE['term_index']})),
g AS (SELECT *, (row_number() OVER (PARTITION BY term, page ORDER BY doc_id) - 1) // {b.INDEX_BLOCK} AS cut FROM p),
d AS (SELECT *, coalesce(doc_id - lag(doc_id) OVER (PARTITION BY term, page, cut ORDER BY doc_id), 0) AS gap FROM g)
SELECT term, page, min(doc_id) AS first_id, max(doc_id) AS last_id, CAST(count(*) AS INTEGER) AS n, string_agg(gap, ' ' ORDER BY doc_id) AS deltas
FROM d GROUP BY term, page, cut""",
    "term_rank_blocks": _TERMS_ORACLE["term_rank_index"],
    "term_both": f"""
SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), '{b.TWO_TERMS[0]}')
  AND list_contains(string_split(text, ' '), '{b.TWO_TERMS[1]}')""",
    "term_rank_long": """
WITH t AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS term FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS term FROM documents)
SELECT term, count(*) AS n_docs FROM d JOIN t USING (term) WHERE term <> '' GROUP BY term""",
    "qa_pairs_bucketed": _posts_cte(b.SCORE_SHIFT) + """
SELECT q.id AS qid, q.tag, a.id AS aid, a.score FROM q JOIN (SELECT parent, aid AS id, score FROM a) a ON a.parent = q.id""",
    "qa_best_bucketed": _QA_ORACLE["qa_best_score_floor"],
    "survey_sql_text": _SURVEY_GROUPED_SQL,
    "term_rank_sql_text": _TERMS_ORACLE["term_rank_fused"],
}

# --------------------------------------------------------------------------- streams

def stream_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running term counts over ``documents`` read as a file stream (state: one row per term)."""
    docs = b.docs_from_documents(st.read_table_stream(spark, sf_dir, "documents"))
    # The state is one row per listed term: a few partitions hold it.
    return st.run_to_table(st.stream_term_counts(docs, b.DOC_TERMS), output_mode="complete",
                           name="stream-term-counts", state_partitions=len(b.DOC_TERMS))


def stream_survey_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-respondent summary of ``lineitem`` read as a file stream (stateless, append)."""
    survey = b.survey_from_lineitem(st.read_table_stream(spark, sf_dir, "lineitem"))
    return st.run_to_table(st.stream_survey_summary(survey), output_mode="append",
                           name="stream-survey-summary")


def stream_best_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best answer scores from ``lineitem`` read as a file stream with event times (state: questions and windows)."""
    posts = b.timed_answers(st.read_table_stream(spark, sf_dir, "lineitem"), score_shift=b.SCORE_SHIFT)
    path = scratch_path(spark, "stream-best")
    # At most a group per row; the files' footers give the count.
    partitions = st.state_partitions(b.table(spark, sf_dir, "lineitem").count(), b.STREAM_PARTITIONS)
    st.run_updates(st.best_scores(posts, time_col="at", window=b.STREAM_WINDOW, lateness=b.STREAM_LATENESS), path,
                   scratch_path(spark, "stream-best-ckpt"), state_partitions=partitions)
    return st.read_best_scores(spark, path)


def stream_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped means of ``lineitem`` read as a file stream with event times (state: groups and windows)."""
    lines = st.read_table_stream(spark, sf_dir, "lineitem")
    survey = b.survey_from_lineitem(lines, keep=("l_shipdate",))
    summary = sv.summarize_time(survey, *sv.classify_columns(survey.columns), keep=("l_shipdate",))
    path = scratch_path(spark, "stream-means")
    st.run_updates(st.group_sums(summary, time_col="l_shipdate", window=b.STREAM_WINDOW, lateness=b.STREAM_LATENESS), path,
                   scratch_path(spark, "stream-means-ckpt"), state_partitions=b.STREAM_PARTITIONS)
    return st.read_group_means(spark, path)


_STREAM_ORACLE = {
    "stream_best_score": _posts_cte(b.SCORE_SHIFT) + " SELECT parent AS qid, score FROM best",
    "stream_group_means": _SURVEY_GROUPED_SQL,
    "stream_term_counts": _TERMS_RANK_SQL,
    "stream_survey_summary": _SURVEY_CTE + """
SELECT working, sex, age, "primaryNeeds", work, other FROM summary
""",
}

ORACLE: dict[str, str] = {
    "survey_summary": _SURVEY_CTE + """
SELECT working, sex, age, "primaryNeeds", work, other FROM summary
""",
    "survey_summary_employable": _SURVEY_CTE + """
SELECT working, sex, age, "primaryNeeds", work, other FROM summary WHERE telfs <> 5
""",
    "survey_grouped": _SURVEY_GROUPED_SQL,
    "survey_grouped_sql": _SURVEY_GROUPED_SQL,
    "survey_grouped_typed": _SURVEY_GROUPED_SQL,
    "survey_wide_grouped": _survey_wide_sql(),
    **_TERMS_ORACLE,
    **_QA_ORACLE,
    **_SOURCES_ORACLE,
    **_MORE_ORACLE,
    **_ASIDE_ORACLE,
    **_BLOCK_ORACLE,
    **_STREAM_ORACLE,
}

QUERIES: dict[str, Query] = {
    "survey_summary": survey_summary,
    "survey_summary_employable": survey_summary_employable,
    "survey_grouped": survey_grouped,
    "survey_grouped_sql": survey_grouped_sql,
    "survey_grouped_typed": survey_grouped_typed,
    "survey_wide_grouped": survey_wide_grouped,
    "term_mentions": term_mentions,
    "term_rank_all": term_rank_all,
    "term_rank_join": term_rank_join,
    "term_index": term_index,
    "term_rank_index": term_rank_index,
    "term_rank_fused": term_rank_fused,
    "term_index_pages": term_index_pages,
    "term_rank_pages": term_rank_pages,
    "page_titles": page_titles,
    "article_titles": article_titles,
    "qa_pairs": qa_pairs,
    "qa_best_score": qa_best_score,
    "qa_best_score_floor": qa_best_score_floor,
    "qa_vectors": qa_vectors,
    "qa_seed": qa_seed,
    "qa_plain_sample": qa_plain_sample,
    "lloyd_step": lloyd_step,
    "lloyd_fit": lloyd_fit,
    "lloyd_fit_converged": lloyd_fit_converged,
    "lloyd_history": lloyd_history,
    "cluster_summary": cluster_summary,
    "cluster_report": cluster_report,
    "cluster_summary_converged": cluster_summary_converged,
    "cluster_report_converged": cluster_report_converged,
    "cluster_report_published": cluster_report_published,
    "posts_roundtrip": posts_roundtrip,
    "wide_csv_roundtrip": wide_csv_roundtrip,
    "wide_csv_grouped": wide_csv_grouped,
    "qa_pair_pages": qa_pair_pages,
    "qa_best_of_pages": qa_best_of_pages,
    "qa_seed_found": qa_seed_found,
    "line_sample": line_sample,
    "lloyd_bounded": lloyd_bounded,
    "lloyd_resumed": lloyd_resumed,
    "posts_good": posts_good,
    "posts_bad": posts_bad,
    "wide_csv_good": wide_csv_good,
    "wide_csv_bad": wide_csv_bad,
    "articles_good": articles_good,
    "articles_bad": articles_bad,
    "term_index_blocks": term_index_blocks,
    "term_rank_blocks": term_rank_blocks,
    "term_both": term_both,
    "term_rank_long": term_rank_long,
    "qa_pairs_bucketed": qa_pairs_bucketed,
    "qa_best_bucketed": qa_best_bucketed,
    "survey_sql_text": survey_sql_text,
    "term_rank_sql_text": term_rank_sql_text,
    "stream_term_counts": stream_term_counts,
    "stream_survey_summary": stream_survey_summary,
    "stream_best_score": stream_best_score,
    "stream_group_means": stream_group_means,
}
