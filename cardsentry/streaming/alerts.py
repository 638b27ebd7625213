"""The alert rate limit on a stream. Every micro-batch runs the batch operator and continues from the last sent times of
each channel. They are a table per batch that holds all channels, so a batch reads that of the batch before and no other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.operators.alerts import MAX_PER_WINDOW, WINDOW_SECONDS, rate_limited_alerts
from cardsentry.streaming.run import batch_folder

STATE = "channel string, times array<long>"


def _sent_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The last sent times per channel as of the batch before this one; micro-batches are numbered without gaps."""
    try:
        return spark.read.schema(STATE).parquet(batch_folder(path, batch_id - 1))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or batch_id > 0:
            raise
        return spark.createDataFrame([], STATE)


def rate_limit_sink(
    sent_path: str,
    state_path: str,
    us: Column,
    row_id: str,
    *,
    channel: Column | None = None,
    limit: int = MAX_PER_WINDOW,
    seconds: float = WINDOW_SECONDS,
) -> Callable[[DataFrame, int], None]:
    """Batch sink: writes the alerts that are sent, then the channels' last sent times. Both belong to the batch, so a
    repeated batch starts from the same state and replaces its output."""
    name = channel if channel is not None else F.lit("")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _sent_before(spark, state_path, batch_id)
        sent = rate_limited_alerts(batch, us, row_id, channel=channel, limit=limit, seconds=seconds, before=before)
        sent.write.mode("overwrite").parquet(batch_folder(sent_path, batch_id))

        written = spark.read.schema(batch.schema).parquet(batch_folder(sent_path, batch_id))
        fresh = written.select(name.cast("string").alias("channel"), us.alias("us")).where("us IS NOT NULL")
        times = before.select("channel", F.explode("times").alias("us")).unionByName(fresh)
        newest = Window.partitionBy("channel").orderBy(F.desc("us"))
        last = times.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit)
        state = last.groupBy("channel").agg(F.sort_array(F.collect_list("us")).alias("times"))
        state.write.mode("overwrite").parquet(batch_folder(state_path, batch_id))

    return each
