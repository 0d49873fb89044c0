"""Kafka topics as message source and sink.

Needs the ``spark-sql-kafka-0-10`` package of the running Spark version on the class path.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import clock


def source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    group_id: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    starting_time: datetime | None = None,
    ending_offsets: str | None = None,
    ending_time: datetime | None = None,
) -> dict[str, str]:
    """Options of a topic scan, from the earliest kept message unless told otherwise.

    ``min_partitions`` splits a topic of few partitions over more reading tasks;
    ``max_offsets_per_trigger`` bounds the first batch of a long topic. Offsets live in the
    checkpoint, so a consumer group is needed only where the broker's access rules name one.
    ``starting_time`` takes the place of ``starting_offsets``: each partition is read from its
    first message of that time on, or from its end. The ends bound a batch (``read_topic``).
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_time is None:
        options["startingOffsets"] = starting_offsets
    else:
        options["startingTimestamp"] = _millis(starting_time)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if ending_time is not None:
        options["endingTimestamp"] = _millis(ending_time)
    elif ending_offsets is not None:
        options["endingOffsets"] = ending_offsets
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def _millis(moment: datetime) -> str:
    return str(int(clock.as_utc(moment).timestamp() * 1000))


def stream_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """New messages as they come. A stream has no end: settings of ends are refused."""
    if settings.get("ending_offsets") or settings.get("ending_time"):
        raise ValueError("only a batch can end at given offsets or at a time")
    options = source_options(servers, topic, **settings)
    return with_message_id(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Everything in the topic up to now, or between the given bounds, as a batch."""
    options = source_options(servers, topic, **settings)
    options.pop("maxOffsetsPerTrigger", None)
    return with_message_id(spark.read.format("kafka").options(**options).load())


def with_message_id(records: DataFrame) -> DataFrame:
    """Keeps the message and its place in the topic, which is its identity."""
    message_id = F.concat_ws(":", "topic", "partition", "offset")
    return records.select("value", message_id.alias("message_id"))


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write message values, without keys, to a topic."""
    options = sink_options(servers, topic)
    messages.select("value").write.format("kafka").options(**options).save()


def stream_publish(
    messages: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    options = sink_options(servers, topic)
    writer = messages.select("value").writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
