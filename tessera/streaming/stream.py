"""Structured Streaming forms of the stateless operators.

The reference is batch only; these helpers let the same operators run on a
stream of new files: the survey summary is a stateless projection (append),
term counts keep one state row per listed term (update/complete), and the
checkpoint lives in the shared folder so a restarted query resumes.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import DEFAULT_SEPARATOR, matching_terms, validate_terms
from tessera.operators import survey as sv
from tessera.session import scratch_path


def read_stream(spark: SparkSession, path: str, *, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, name_glob: str | None = None) -> DataFrame:
    """Stream the files of folder ``path`` (only names matching ``name_glob`` if given).

    The schema comes from the files already there.
    """
    batch = spark.read.format(fmt)
    reader = spark.readStream.format(fmt)
    if name_glob:
        batch = batch.option("pathGlobFilter", name_glob)
        reader = reader.option("pathGlobFilter", name_glob)
    reader = reader.schema(batch.load(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_table_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Stream the table ``<table>.parquet`` of a folder of tables, one file or a folder of part files.

    The path is given as a pattern, which a file stream takes for either.
    """
    base = f"{folder.rstrip('/')}/"
    schema = spark.read.parquet(f"{base}{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{base}{{{table}}}.parquet")


def stream_term_counts(docs: DataFrame, terms: Sequence[str], *, text_col: str = "text",
                       sep: str = DEFAULT_SEPARATOR) -> DataFrame:
    """Running (term, n_docs) over a document stream; state holds one row per listed term."""
    terms = validate_terms(terms)
    return (docs.select(F.explode(matching_terms(text_col, terms, sep)).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n_docs")))


def stream_survey_summary(survey: DataFrame, **kwargs) -> DataFrame:
    """Per-respondent summary of a survey stream (stateless, append mode)."""
    p, w, o = sv.classify_columns(survey.columns)
    return sv.summarize_time(survey, p, w, o, **kwargs)


# Rows a partition of a stream's state is sized for, and the most partitions.
STATE_ROWS = 500_000
MAX_STATE_PARTITIONS = 16_384


def state_partitions(rows: int, least: int = 1) -> int:
    """Partitions for a state of up to ``rows`` groups: one task's share stays the same however many there are."""
    return min(MAX_STATE_PARTITIONS, max(least, -(-rows // STATE_ROWS)))


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings while a stream starts (it keeps them for its life)."""
    old = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _shuffle_partitions(spark: SparkSession, n: int | None) -> contextlib.AbstractContextManager[None]:
    """Set the shuffle partitions while a stream starts (it keeps them for its life).

    Streams run without AQE, so nothing coalesces a cluster's large batch
    default; a stateful stream would run that many state-store tasks per
    micro-batch. The value is saved in the stream's checkpoint on first start.
    """
    return _settings(spark, {} if n is None else {"spark.sql.shuffle.partitions": str(n)})


def run_to_table(df: DataFrame, *, output_mode: str, name: str, timeout_s: float | None = None,
                 state_partitions: int | None = None) -> DataFrame:
    """Drain a stream of the files present now into a table in the shared folder; read it back.

    ``append`` writes with the parquet file sink (exactly once through its log).
    ``complete`` writes the whole result anew with each micro-batch, in a folder
    of its own, and the last one is read: a reader never sees a table half
    overwritten. Use it only for results of bounded size (one row per listed
    term, say). ``state_partitions`` sets the shuffle partitions of a stateful
    stream; it is a session setting while the stream starts, so start such
    streams from one thread.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    ckpt = scratch_path(spark, f"{name}-ckpt")
    writer = (df.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
              .trigger(availableNow=True))
    if output_mode not in ("append", "complete"):
        raise ValueError("output_mode must be 'append' or 'complete'")
    batches: list[int] = []

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number}")
        batches.append(number)

    with _shuffle_partitions(spark, state_partitions):
        if output_mode == "append":
            query = writer.format("parquet").start(path)
        else:
            query = writer.foreachBatch(write_batch).start()
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {name} did not finish")
    if query.exception() is not None:
        raise query.exception()
    if output_mode == "append":
        return spark.read.schema(df.schema).parquet(path)
    return spark.read.parquet(f"{path}/{batches[-1]}") if batches else spark.createDataFrame([], df.schema)


def start(df: DataFrame, *, output_mode: str, sink: str = "parquet", path: str | None = None,
          query_name: str | None = None, checkpoint: str | None = None,
          trigger_once: bool = False, state_partitions: int | None = None) -> StreamingQuery:
    """Start a stream with its checkpoint under the shared folder (unless one is given)."""
    spark = df.sparkSession
    writer = (df.writeStream.outputMode(output_mode).format(sink)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    with _shuffle_partitions(spark, state_partitions):
        return writer.start(path) if path else writer.start()
