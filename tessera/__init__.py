"""tessera: Spark-native text ranking, Q/A clustering and survey analytics.

Every operator takes and returns DataFrames; the heavy work is expressed with
built-in column expressions, joins and aggregates so Catalyst can prune,
push down and plan it. The names below are the public surface; each lives in
``tessera.operators``, ``tessera.sources``, ``tessera.functions`` or
``tessera.streaming``.
"""

from tessera.operators.clusters import cluster_report, print_report, summarize_clusters
from tessera.operators.lloyd import (
    assign_nearest,
    centroid_sums,
    fit_lloyd,
    history_frame,
    lloyd_update,
    point_histogram,
)
from tessera.operators.pairs import best_child_score, pair_parent_child
from tessera.operators.quantiles import exact_median
from tessera.operators.survey import (
    average_by_group,
    average_by_group_sql,
    average_by_group_typed,
    classify_columns,
    conform,
    summarize_time,
)
from tessera.operators.terms import build_index, build_index_pages, mention_count, rank_from_index, rank_terms
from tessera.operators.vectors import initial_centers, plain_sample, seed_centers, to_vectors
from tessera.session import build_session, checkpoint_dir, clear_scratch
from tessera.sources.markup import extract_marked
from tessera.sources.text import format_posts, parse_posts, read_lines, read_posts
from tessera.sources.widecsv import read_wide_csv, schema_from_header, write_wide_csv

__all__ = [
    "assign_nearest", "average_by_group", "average_by_group_sql", "average_by_group_typed",
    "best_child_score", "build_index", "build_index_pages", "build_session", "centroid_sums",
    "checkpoint_dir", "classify_columns", "clear_scratch", "cluster_report", "conform", "exact_median", "extract_marked",
    "fit_lloyd", "format_posts", "history_frame", "initial_centers", "lloyd_update", "mention_count",
    "pair_parent_child", "parse_posts", "plain_sample", "point_histogram", "print_report",
    "rank_from_index", "rank_terms", "read_lines", "read_posts", "read_wide_csv", "schema_from_header",
    "seed_centers", "summarize_clusters", "summarize_time", "to_vectors", "write_wide_csv",
]
