"""Kafka source and sink. They need the spark-sql-kafka package on the cluster; parsing is shared with the files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardsentry.sources.files import parse_json_text, to_json_text

# The defaults of the exchanged topic.
BROKERS, TOPIC, GROUP = "localhost:9092", "transactions", "fraud-detection-group"


def read_transaction_topic(
    spark: SparkSession, schema: T.StructType, servers: str = BROKERS, topic: str = TOPIC, group: str = GROUP
) -> DataFrame:
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.group.id", group)
        .load()
    )
    return parse_messages(messages, schema)


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Binary message values to columns; broken messages carry their text in ``_corrupt_record``."""
    return parse_json_text(messages.select(F.col("value").cast("string").alias("text")), "text", schema)


def write_transaction_topic(df: DataFrame, servers: str = BROKERS, topic: str = TOPIC) -> None:
    to_json_text(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def stream_to_topic(df: DataFrame, checkpoint: str, servers: str = BROKERS, topic: str = TOPIC) -> StreamingQuery:
    return (
        to_json_text(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
