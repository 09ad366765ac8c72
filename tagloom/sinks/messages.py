"""Message sinks: one topic, or one topic per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

DURABLE = {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def kafka_options(servers: str, topic: str | None = None, durable: bool = False, **further: str) -> dict[str, str]:
    """Without ``topic`` each row goes to the topic its ``topic`` column names; ``further`` options win over the fixed ones."""
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return {**options, **(DURABLE if durable else {}), **further}


def write_messages(
    messages: DataFrame, servers: str, topic: str | None = None, durable: bool = False, **further: str
) -> None:
    """Batch write of the ``value`` column (and ``topic``, if rows are routed)."""
    columns = ["value"] if topic is not None else ["topic", "value"]
    messages.select(*columns).write.format("kafka").options(**kafka_options(servers, topic, durable, **further)).save()


def stream_messages(
    messages: DataFrame,
    name: str,
    checkpoint: str,
    servers: str,
    topic: str | None = None,
    durable: bool = False,
    every: str = "3 seconds",
    **further: str,
) -> StreamingQuery:
    """Streaming write. A fixed ``name`` and ``checkpoint`` let a restarted query go on where it stopped."""
    columns = ["value"] if topic is not None else ["topic", "value"]
    return (
        messages.select(*columns)
        .writeStream.format("kafka")
        .options(**kafka_options(servers, topic, durable, **further))
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def write_routed(messages: DataFrame, path: str) -> None:
    """Routed messages as text files, one folder per topic; a single pass over the input."""
    messages.select("topic", "value").write.partitionBy("topic").text(path)


def stream_routed(messages: DataFrame, name: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The same for a stream; each file is final exactly once."""
    return (
        messages.select("topic", "value")
        .writeStream.format("text")
        .partitionBy("topic")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
