"""Topics into the raw layer, exactly once, unparsed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None
) -> DataFrame:
    """Messages of a topic from its beginning; needs the Kafka connector on the class path.

    ``max_per_trigger`` (say 1000) bounds one micro-batch; unset, a batch takes what has
    arrived, which is what a large backlog needs.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_topic(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from text files dropped into a folder, one per line."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def landable(messages: DataFrame) -> DataFrame:
    """Messages that carry something, each on one line.

    Tombstones, empty values and JSON ``null`` go. Line breaks are put on one line: inside
    a JSON string they are escaped, so a bare one is only layout.
    """
    one_line = F.regexp_replace("value", r"[\r\n]+", " ")
    return messages.select(one_line.alias("value")).where(
        F.col("value").isNotNull() & ~F.trim("value").isin("", "null")
    )


def ingest_stream(
    messages: DataFrame, target: str, checkpoint: str, compression: str = "none"
) -> StreamingQuery:
    """Take everything that has arrived since the last run into ``target`` and stop.

    Offsets live in ``checkpoint`` and the sink logs its commits, so a restart neither repeats
    nor loses a message. Read ``target`` itself, not a parent folder, to honour that log.
    """
    return (
        landable(messages)
        .writeStream.format("text")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", compression)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
