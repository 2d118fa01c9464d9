"""Text outputs: JSON lines in folders, messages to topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.spec import RunConfig


def json_lines(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON document per row; null members are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def write_json_text(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """JSON lines, replacing what is there; every task writes its own file."""
    json_lines(df, columns).write.mode("overwrite").text(path)


def topic_messages(df: DataFrame, value: str = "value", key: str | None = None) -> DataFrame:
    """Message shape for a topic; the key is null unless one is named."""
    message_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(message_key.alias("key"), F.col(value).cast("string").alias("value"))


def ack_messages(log: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Acknowledgements for the topics ``<source>_committed``: the key of each stored document."""
    stored = log.where(F.col("status") == "ok")
    return stored.select(
        F.concat("source", F.lit(config.commit_suffix)).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.col("key").cast("string").alias("value"),
    )


def write_topic(
    df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None, **options: str
):
    """Publish to a topic, or to the topic each row names in its column ``topic``; failures fail the
    job. A stream needs a checkpoint folder."""
    settings = {"kafka.bootstrap.servers": servers, **({"topic": topic} if topic else {}), **options}
    if df.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming write needs a checkpoint folder")
        return df.writeStream.format("kafka").options(**settings).option(
            "checkpointLocation", checkpoint
        ).start()
    return df.write.format("kafka").options(**settings).save()
