"""Loading lookup tables, also while streams read them.

Layout: ``<path>/version=<n>-<id>/``, one folder per load. Readers take the newest that is complete, so a reload
neither takes files away from a running batch nor leaves a moment without a table. Two loads at the same time may get the same
number, but not the same folder; the later name of the two is read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.latest import latest_per_key
from millrace.sinks.current import Files

# A version goes when a newer one has been there for so long: no reader may take longer.
KEPT_SECONDS = 24 * 3600.0


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """Complete versions, oldest first: number, folder, time of completion in milliseconds."""
    files, found = Files(spark, path), []
    for name, _ in files.children(path):
        if name.startswith("version="):
            done = [t for n, t in files.children(f"{path}/{name}") if n == "_SUCCESS"]
            found += [(int(name.removeprefix("version=").split("-")[0]), name, t) for t in done]
    return sorted(found)


def load_lookup(
    df: DataFrame, path: str, key: str, version: Sequence[str] = (), kept_seconds: float = KEPT_SECONDS
) -> DataFrame:
    """Replace the stored lookup table with one row per key; loading twice does not duplicate.

    Versions that were replaced more than ``kept_seconds`` ago are removed, whatever their number.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    number = max((n for n, _, _ in _versions(spark, path)), default=0) + 1
    latest_per_key(df, [key], version).write.parquet(f"{path}/version={number}-{uuid.uuid4().hex[:12]}")
    known, horizon = _versions(spark, path), 1000 * (time.time() - kept_seconds)
    for (_, name, _), (_, _, replaced) in zip(known, known[1:]):
        if replaced <= horizon:
            Files(spark, path).delete(f"{path}/{name}")
    return read_lookup(spark, path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The newest version. Streams call this in every micro-batch."""
    path = path.rstrip("/")
    known = _versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no lookup table has been loaded to {path}")
    return spark.read.parquet(f"{path}/{known[-1][1]}")
