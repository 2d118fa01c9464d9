"""Several sources seen as one: topics, growing folders, or tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.spec import RunConfig


def union_sources(parts: Mapping[str, DataFrame], source: str = "source") -> DataFrame:
    """One stream of rows from several, each row tagged with the source it came from."""
    tagged = [df.withColumn(source, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_of(topic: Column, sources: Mapping[str, str]) -> Column:
    """The source that a topic stands for."""
    name = topic
    for key, source in sources.items():
        name = F.when(topic == key, F.lit(source)).otherwise(name)
    return name


def read_topics(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] | None = None,
    pattern: str | None = None,
    streaming: bool = True,
    sources: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Subscribe to topics from the earliest offset; the value is UTF-8 text. ``sources`` names the source of
    each topic; a topic that it does not name is its own source."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    subscription = ("subscribe", ",".join(topics)) if topics else ("subscribePattern", pattern)
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    return (
        reader.option("kafka.bootstrap.servers", servers)
        .option(*subscription)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(
            F.col("value").cast("string").alias("value"),
            source_of(F.col("topic"), sources or {}).alias("source"),
            F.col("timestamp").alias("arrived"),
            F.col("partition"),
            F.col("offset"),
        )
    )


def topic_acks(messages: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Messages of ``<source>_committed`` topics as acknowledgements; the source is kept."""
    name = F.col("source")
    bare = F.left(name, F.length(name) - len(config.commit_suffix))
    source = F.when(name.endswith(config.commit_suffix), bare)
    return messages.select(
        F.col("value").alias("key"),
        F.coalesce(source, name).alias("source"),
        F.col("arrived").alias("commit_ts"),
        F.col("offset").alias("seq"),
    )


def read_file_streams(
    spark: SparkSession,
    folders: Mapping[str, str],
    schema: T.StructType,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Growing folders, one per source, as one stream."""
    parts = {
        name: spark.readStream.format(fmt).schema(schema).options(**options).load(path)
        for name, path in folders.items()
    }
    return union_sources(parts)
