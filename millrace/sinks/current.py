"""The current documents of a store, kept up to date beside its history.

Layout below the store's root::

    current/data/gen=<g>/bucket=<b>/   newest document by (source, key)
    current/switch/<n>.json            which generations hold which bucket

A bucket is a hash of the key. A refresh reads the batches that came since the last one, merges their newest documents with the
rows of the buckets they touch, writes these buckets anew into a generation of its own, and then writes the next switch.
A store may let a bucket have several generations, each with one document per key, before they are merged.
Readers go by the newest switch, so they see the state before a refresh or after it and nothing between; what a refresh that
died has written is never looked at. Rows of a bucket are sorted by source and key and carry Bloom filters, so that a search
for one source or for a few keys skips most row groups.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    """Keys of any type that are the same as text fall into the same bucket."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def bloom_filter(key: str) -> dict[str, str]:
    """Options of a Parquet writer: a Bloom filter of the keys in each row group, as large as they need."""
    return {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


class Files:
    """The few file operations that the driver needs, on whatever file system a path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def children(self, path: str) -> list[tuple[str, int]]:
        """Names in a folder, with the time of their last change in milliseconds."""
        place = self._path(path)
        if not self.fs.exists(place):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(place)]

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that is there as a whole or not at all. False if there was one already."""
        place, draft = self._path(path), self._path(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        done = not self.fs.exists(place) and self.fs.rename(draft, place)
        if not done:
            self.fs.delete(draft, False)
        return done

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


@dataclass
class Switch:
    """What is current: the generations of each bucket that has rows, and the last batch of each job that is in them."""

    number: int = 0
    buckets: int = 0
    places: dict[int, list[str]] = field(default_factory=dict)
    upto: dict[str, int] = field(default_factory=dict)
    schema: str | None = None

    def text(self) -> str:
        places = {str(b): g for b, g in self.places.items()}
        return json.dumps({"buckets": self.buckets, "places": places, "upto": self.upto, "schema": self.schema})

    @classmethod
    def parse(cls, number: int, text: str) -> "Switch":
        found = json.loads(text)
        places = {int(b): g for b, g in found["places"].items()}
        return cls(number, found["buckets"], places, found["upto"], found["schema"])


class Current:
    """The buckets of one store."""

    def __init__(self, root: str):
        self.root = f"{root}/current"

    def switch(self, spark: SparkSession) -> Switch:
        """The newest, or an empty one."""
        files = Files(spark, self.root)
        names = [n for n, _ in files.children(f"{self.root}/switch") if n.endswith(".json")]
        if not names:
            return Switch()
        newest = max(names)
        return Switch.parse(int(newest.removesuffix(".json")), files.read(f"{self.root}/switch/{newest}"))

    def rows(self, spark: SparkSession, switch: Switch, buckets: Iterable[int]) -> DataFrame | None:
        """What these buckets hold; null if that is nothing. Only their folders are listed."""
        paths = [f"{self.root}/data/gen={g}/bucket={b}" for b in buckets for g in switch.places.get(b, [])]
        if not paths:
            return None
        schema = T.StructType.fromJson(json.loads(switch.schema))
        folders = T.StructType([T.StructField("gen", T.StringType()), T.StructField("bucket", T.IntegerType())])
        reader = spark.read.schema(T.StructType([*schema.fields, *folders.fields])).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*schema.names)

    def write(
        self, spark: SparkSession, switch: Switch, merged: DataFrame, key: str, touched: Iterable[int], replaced: Iterable[int], upto: dict[str, int]
    ) -> Switch:
        """Put the rows of the touched buckets in a new generation and switch to it: in place of the generations before it for the
        replaced ones, beside them for the others. ``merged`` has a column of bucket numbers."""
        generation = f"{switch.number + 1:010d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/gen={generation}"
        # A bucket of a hot key is cut into several files; within a file rows are in order of the key.
        dealt = merged.hint("rebalance", BUCKET).withColumnRenamed(BUCKET, "bucket").sortWithinPartitions("bucket", "source", key)
        dealt.write.partitionBy("bucket").options(**bloom_filter(key)).parquet(path)
        files = Files(spark, self.root)
        places, gone = dict(switch.places), set(replaced)
        for bucket in touched:
            places[bucket] = [*([] if bucket in gone else places.get(bucket, [])), generation]
        plain = T.StructType([f for f in merged.schema.fields if f.name != BUCKET])
        following = Switch(switch.number + 1, switch.buckets, places, {**switch.upto, **upto}, plain.json())
        if not files.create(f"{self.root}/switch/{following.number:010d}.json", following.text()):
            files.delete(path)
            raise RuntimeError(f"another refresh of {self.root} came first")
        return following

    def prune(self, spark: SparkSession, older_than_seconds: float, now_ms: int) -> list[str]:
        """Remove generations that no switch of the last while names, and older switches. Readers that began before
        that while are left without files."""
        files = Files(spark, self.root)
        horizon = now_ms - 1000 * older_than_seconds
        switches = sorted((n, t) for n, t in files.children(f"{self.root}/switch") if n.endswith(".json"))
        # A switch is in use until the next one has been there for the whole while.
        used = [n for i, (n, _) in enumerate(switches) if i + 1 == len(switches) or switches[i + 1][1] > horizon]
        places = [Switch.parse(0, files.read(f"{self.root}/switch/{n}")).places for n in used]
        live = {f"gen={g}" for p in places for generations in p.values() for g in generations}
        gone = [g for g, t in files.children(f"{self.root}/data") if g not in live and t <= horizon]
        for generation in gone:
            files.delete(f"{self.root}/data/{generation}")
        for name, _ in switches:
            if name not in used:
                files.delete(f"{self.root}/switch/{name}")
        return gone

