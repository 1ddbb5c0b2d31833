"""Best scores and group means over streams, with state that old time windows leave.

The state is keyed by the group and a time window of the row: partial maxima,
sums and counts. A window leaves the state once the watermark has passed it, so
the state holds what is younger than the allowed lateness, not every group ever
seen. Changed rows are written batch by batch (update mode) to folders named by
the batch, so a batch that a restart repeats replaces its own; the table is read
as the last row of each group and window, combined over the windows.

The state lies in RocksDB on the executors' disks, not in their heap, and a task
holds one partition's groups of the batch: choose the partitions by the rows to
come (``state_partitions``). The provider and the partitions are saved in the
checkpoint, so a stream that began with others goes on with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.pairs import ANSWER, _no_parent
from tessera.operators.survey import GROUP_KEYS, MEASURES
from tessera.session import path_exists
from tessera.streaming.stream import _settings, _shuffle_partitions

_BATCH = "batch"
# Files are read in splits of this size at most, as a task's partial aggregate grows with its split.
SPLIT_BYTES = 32 << 20
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One bound for all the stores of an executor; a store that has committed without a change log holds no write buffer.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def windowed(stream: DataFrame, keys: Sequence[str], aggs: Sequence[Column], *, time_col: str, window: str, lateness: str) -> DataFrame:
    """The aggregates of each group and time window; rows later than ``lateness`` behind the newest are dropped."""
    return stream.withWatermark(time_col, lateness).groupBy(*keys, F.window(time_col, window).alias("window")).agg(*aggs)


def best_scores(posts: DataFrame, *, time_col: str, window: str, lateness: str, strict: bool = True) -> DataFrame:
    """(qid, window, score): the best answer score of each question, from a stream of posts with a time column.

    An answer without a parent id fails the stream unless ``strict=False``,
    which leaves it out.
    """
    answers = posts.where(F.col("ptype") == ANSWER)
    parent = F.col("parent")
    answers = answers.where(_no_parent(parent, F.lit(True)).cast("boolean") if strict else parent.isNotNull())
    return windowed(answers.withColumnRenamed("parent", "qid"), ["qid"], [F.max("score").alias("score")],
                    time_col=time_col, window=window, lateness=lateness)


def group_sums(summary: DataFrame, *, time_col: str, window: str, lateness: str, keys: Sequence[str] = GROUP_KEYS,
               measures: Sequence[str] = MEASURES) -> DataFrame:
    """Per group and window the sums and counts of the measures of a stream of summaries with a time column."""
    aggs = [c for m in measures for c in (F.sum(m).alias(m), F.count(m).alias(f"n_{m}"))]
    return windowed(summary, keys, aggs, time_col=time_col, window=window, lateness=lateness)


def run_updates(df: DataFrame, path: str, checkpoint: str, *, state_partitions: int | None = None) -> StreamingQuery:
    """Drains the files present now into folders ``batch=n`` below ``path``; starts where ``checkpoint`` stands."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    spark, split = df.sparkSession, "spark.sql.files.maxPartitionBytes"
    bytes_now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(split))
    with _settings(spark, {split: str(min(SPLIT_BYTES, bytes_now))}):  # the files are read with the session's own value
        with _settings(spark, _STATE_STORE), _shuffle_partitions(spark, state_partitions):
            query = writer.foreachBatch(write).start()
        query.awaitTermination()
    return query


def _last_rows(spark: SparkSession, path: str, schema: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values that each group and window had in the last batch that changed it."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, {_BATCH} bigint").parquet(path)
    last = rows.groupBy(*keys, "window").agg(F.max_by(F.struct(*values), _BATCH).alias("v"))
    return last.select(*keys, "window", "v.*")


def read_best_scores(spark: SparkSession, path: str) -> DataFrame:
    """(qid, score) of every question with an answer so far.

    A window's best score never falls from batch to batch, so the highest of
    all its rows is the last one's.
    """
    schema = f"qid bigint, window struct<start: timestamp, end: timestamp>, score int, {_BATCH} bigint"
    rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return rows.groupBy("qid").agg(F.max("score").alias("score"))


def read_group_means(spark: SparkSession, path: str, *, keys: Sequence[str] = GROUP_KEYS, measures: Sequence[str] = MEASURES,
                     scale: int = 1) -> DataFrame:
    """The grouped means so far, rounded and sorted as ``average_by_group``'s."""
    values = [c for m in measures for c in (m, f"n_{m}")]
    schema = ", ".join([*(f"`{k}` string" for k in keys), "window struct<start: timestamp, end: timestamp>",
                        *(f"`{m}` double, `n_{m}` bigint" for m in measures)])
    rows = _last_rows(spark, path, schema, keys, values)
    return rows.groupBy(*keys).agg(*[F.round(F.sum(m) / F.nullif(F.sum(f"n_{m}"), F.lit(0)), scale).alias(m) for m in measures]).orderBy(*keys)
