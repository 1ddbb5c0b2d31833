"""Streaming forms of operators: term counts, survey summary, best scores, group means."""

from tessera.streaming.running import best_scores, group_sums, read_best_scores, read_group_means, run_updates
from tessera.streaming.stream import (
    read_stream,
    read_table_stream,
    run_to_table,
    start,
    state_partitions,
    stream_survey_summary,
    stream_term_counts,
)

__all__ = ["best_scores", "group_sums", "read_best_scores", "read_group_means", "read_stream", "read_table_stream", "run_to_table",
           "run_updates", "start", "state_partitions", "stream_survey_summary", "stream_term_counts"]
