"""Files to rows on a stream, with counts of what came in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.delimited import BAD
from millrace.streaming.jobs import start, write_batch

COUNTS = "source STRING, good BIGINT, malformed BIGINT"


def start_ingest(
    split: DataFrame,
    sources: Sequence[str],
    out: str,
    checkpoint: str,
    source: str = "source",
    once: bool = False,
    interval: str = "20 seconds",
) -> StreamingQuery:
    """Write the rows of a stream of ``split_delimited`` below ``out/rows``, malformed ones beside the good, and count both per
    source below ``out/counts``, one small table per micro-batch.

    Rows are counted while they are written, in the same pass. A replayed micro-batch replaces its rows and its counts. Rows of
    none of the ``sources`` are written as well and counted under a null source.
    """
    spark = split.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"ingest-{batch_id}")
        known = F.coalesce(F.col(source).isin(*sources), F.lit(False))
        places = [(i, F.col(source) == name) for i, name in enumerate(sources)] + [("other", ~known)]
        counts = [F.count_if(mine & F.col(BAD)).alias(f"bad_{i}") for i, mine in places]
        counts += [F.count_if(mine & ~F.col(BAD)).alias(f"good_{i}") for i, mine in places]
        write_batch(batch.observe(seen, *counts), f"{out}/rows", batch_id)
        found = seen.get
        lines = [(name, found[f"good_{i}"], found[f"bad_{i}"]) for i, name in [*enumerate(sources), ("other", None)]]
        lines = [line for line in lines if line[1] or line[2]]
        write_batch(spark.createDataFrame(lines, COUNTS).coalesce(1), f"{out}/counts", batch_id)

    return start(split.writeStream.foreachBatch(write), checkpoint, once, interval)


def ingest_totals(spark: SparkSession, out: str) -> DataFrame:
    """Good and malformed rows per source so far."""
    counts = spark.read.schema(COUNTS).parquet(f"{out}/counts")
    return counts.groupBy("source").agg(F.sum("good").alias("good"), F.sum("malformed").alias("malformed"))


def ingested_rows(spark: SparkSession, out: str, split: DataFrame) -> DataFrame:
    """All rows so far, with the columns of ``split``; ``good_rows`` and ``quarantined_rows`` tell them apart."""
    return spark.read.schema(split.schema).parquet(f"{out}/rows").select(*split.columns)
