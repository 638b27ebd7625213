"""Starting streams and their sinks. Every sink is replayable: a repeated micro-batch replaces its own output."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State beyond the executor's heap; needed by the keyed processors."""
    spark.conf.set(STATE_STORE, ROCKSDB)


def process_available(
    df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Run the stream over everything that is there now, then stop."""
    query = (
        df.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return each


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def latest_per_key(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of every key of an update-mode stream that was written batch by batch."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
