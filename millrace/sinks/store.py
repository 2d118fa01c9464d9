"""A keyed document store on plain Parquet, with a commit log.

Layout below the root::

    data/job=.../batch_id=.../status=ok|failed/source=.../   every document as it was written
    log/job=.../batch_id=.../                                 one row per written document
    current/                                                  the newest version of each key, by key hash
    schema/<md5>.json                                         the schemas of batches

Each job that writes has a name and numbers its own batches, so jobs do not meet. Batches are only ever
appended or replaced as a whole, so writing the same batch again (after a restart) leaves the store as it
was. The current state is the newest version per key: ``refresh`` brings the table of current documents up to date, and
what came after it is merged when the state is read. Files are sorted by key and carry Bloom filters on it, so that
``fetch`` leaves most row groups unread when it looks for few keys. Documents may have columns named like the
store's own; they are kept under another name and come back under theirs.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.latest import latest_per_key, newest_struct
from millrace.operators.skew import join_unique
from millrace.sinks.current import BUCKET, Current, Files, Switch, bloom_filter, bucket_of

FOLDERS = {"job": T.StringType(), "batch_id": T.LongType(), "status": T.StringType(), "source": T.StringType()}
# Names the store uses itself; a document's own columns of that name are stored with the prefix.
RESERVED = ("job", "batch_id", "status", "error", "gen", "bucket")
OWN = "_document_"
BUCKETS = 64
# So many keys are looked for by a filter that reaches the Bloom filters of the files; more by a join.
PUSHED_KEYS = 200


class Store:
    """Documents of other sources than ``sources`` are refused, if these are given. Current documents are dealt over
    ``buckets`` by their key (the first refresh settles how many), and a bucket has at most ``generations`` tables: with one,
    a refresh writes each bucket it touches anew; with more it writes less, and reading merges them."""

    def __init__(
        self, root: str, key: str, version: Sequence[str], sources: Sequence[str] | None = None,
        buckets: int = BUCKETS, generations: int = 1,
    ):
        self.root = root.rstrip("/")
        self.key = key
        self.version = list(version)
        self.sources = None if sources is None else list(sources)
        self.buckets = buckets
        self.generations = generations
        self.view = Current(self.root)

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def fault(self) -> Column:
        """Why a document cannot be stored; null when it can."""
        fault = (
            F.when(F.col("source").isNull() | (F.col("source") == ""), "missing source")
            .when(F.col(self.key).isNull(), "missing key")
            .when(F.col(self.version[0]).isNull(), "missing version")
        )
        return fault if self.sources is None else fault.when(~F.col("source").isin(*self.sources), "unknown source")

    def batch_path(self, kind: str, job: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/job={job}/batch_id={batch_id}"

    def write_batch(self, docs: DataFrame, batch_id: int, committed: Column | None = None, job: str = "main") -> None:
        """Store a batch, then acknowledge what can be read back. Usable in ``foreachBatch``.

        ``docs`` has the columns of a document and ``source``. Nothing is dropped: documents that
        cannot be stored are kept under ``status=failed`` and logged with the reason. All that ``job``
        wrote under this number before is replaced.
        """
        spark = docs.sparkSession
        path = self.batch_path("data", job, batch_id)
        named = docs.withColumnsRenamed({c: OWN + c for c in RESERVED})
        marked = named.withColumn("error", self.fault()).withColumn(
            "status", F.when(F.col("error").isNull(), "ok").otherwise("failed")
        )
        self._note_schema(spark, marked.schema)
        dealt = marked.sortWithinPartitions("status", "source", self.key)
        dealt.write.mode("overwrite").partitionBy("status", "source").options(**bloom_filter(self.key)).parquet(path)
        # Read back this batch's folder: a document is acknowledged only once a reader can see it.
        try:
            stored = self._read(spark, path)
        except AnalysisException as e:
            if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            stored = marked.limit(0)  # an empty batch has no files
        commit_ts = committed if committed is not None else F.current_timestamp()
        stored.select(
            "source",
            F.col(self.key).alias("key"),
            "status",
            "error",
            commit_ts.alias("commit_ts"),
            F.monotonically_increasing_id().alias("seq"),
        ).write.mode("overwrite").parquet(self.batch_path("log", job, batch_id))

    def _note_schema(self, spark: SparkSession, schema: T.StructType) -> None:
        """Keep the columns of a batch; one small file for each set of them."""
        files = Files(spark, self.root)
        if not files.exists(f"{self.root}/schema") and files.exists(self.data_path):
            # A store that was begun without notes.
            self._note(files, spark.read.option("basePath", self.data_path).option("mergeSchema", "true").parquet(self.data_path).schema)
        self._note(files, schema)

    def _note(self, files: Files, schema: T.StructType) -> None:
        text = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in FOLDERS]).json()
        path = f"{self.root}/schema/{hashlib.md5(text.encode()).hexdigest()}.json"
        if not files.exists(path):
            files.create(path, text)

    def _schema(self, spark: SparkSession) -> T.StructType | None:
        """All columns of all batches, without a look into their files; null for a store that never noted any."""
        files, fields = Files(spark, self.root), {}
        notes = sorted((t, n) for n, t in files.children(f"{self.root}/schema") if n.endswith(".json"))
        for _, name in notes:
            for f in T.StructType.fromJson(json.loads(files.read(f"{self.root}/schema/{name}"))).fields:
                known = fields.setdefault(f.name, f).dataType.simpleString()
                if known != f.dataType.simpleString():
                    raise ValueError(f"column {f.name} is {known} in one batch and {f.dataType.simpleString()} in another")
        return T.StructType(list(fields.values())) if fields else None

    def _read(self, spark: SparkSession, path: str | Sequence[str] | None = None) -> DataFrame:
        paths = [path or self.data_path] if path is None or isinstance(path, str) else path
        # Folder names are text; do not let "007" be read as a number. Later batches may have more columns.
        reader = spark.read.option("basePath", self.data_path)
        schema = self._schema(spark)
        if schema is None:
            found = reader.option("mergeSchema", "true").parquet(*paths).schema
            schema = T.StructType([f for f in found if f.name not in FOLDERS])
        folders = [T.StructField(name, kind) for name, kind in FOLDERS.items()]
        return reader.schema(T.StructType([*schema.fields, *folders])).parquet(*paths)

    def _stored(self, spark: SparkSession, status: str, source: str | None = None) -> DataFrame:
        docs = self._read(spark).where(F.col("status") == status)
        return docs if source is None else docs.where(F.col("source") == source)

    @staticmethod
    def _restored(docs: DataFrame) -> DataFrame:
        """The document's own columns under their names."""
        own = [c for c in docs.columns if c.startswith(OWN)]
        return docs.drop(*[c.removeprefix(OWN) for c in own]).withColumnsRenamed({c: c.removeprefix(OWN) for c in own})

    def documents(self, spark: SparkSession, source: str | None = None) -> DataFrame:
        """Every stored version; the source filter prunes folders."""
        return self._restored(self._stored(spark, "ok", source).drop("status", "error", "job"))

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Documents that could not be stored; ``error`` says why."""
        return self._restored(self._stored(spark, "failed").drop("status", "job"))

    def _latest(self, docs: DataFrame) -> DataFrame:
        return latest_per_key(docs, ["source", self.key], [*self.version, "batch_id"])

    def _batches(self, spark: SparkSession, kind: str) -> list[tuple[str, int]]:
        files, found = Files(spark, self.root), []
        for job, _ in files.children(f"{self.root}/{kind}"):
            for batch, _ in files.children(f"{self.root}/{kind}/{job}") if job.startswith("job=") else []:
                if batch.startswith("batch_id="):
                    found.append((job.removeprefix("job="), int(batch.removeprefix("batch_id="))))
        return found

    def _batch_documents(self, spark: SparkSession, batches: Iterable[tuple[str, int]]) -> DataFrame | None:
        """The stored documents of some batches; null if there are none."""
        files = Files(spark, self.root)
        paths = [f"{self.batch_path('data', job, number)}/status=ok" for job, number in batches]
        paths = [p for p in paths if files.exists(p)]
        return self._read(spark, paths).drop("status", "error", "job") if paths else None

    def _news(self, spark: SparkSession, switch: Switch) -> DataFrame | None:
        """Documents of all batches after the last refresh."""
        return self._batch_documents(spark, [b for b in self._batches(spark, "data") if b[1] > switch.upto.get(b[0], -1)])

    def _touched(self, docs: DataFrame, buckets: int) -> list[int]:
        """The buckets that some documents belong to: a few numbers, from the key column alone."""
        return sorted(r[0] for r in docs.select(bucket_of(F.col(self.key), buckets)).distinct().collect())

    def refresh(self, spark: SparkSession) -> Switch:
        """Bring the current documents up to date with all acknowledged batches. One job at a time does this; readers and
        writers go on meanwhile. A refresh that dies leaves everything as it was."""
        switch = self.view.switch(spark)
        switch.buckets = switch.buckets or self.buckets
        files = Files(spark, self.root)
        new = [
            (job, number) for job, number in self._batches(spark, "log")
            if number > switch.upto.get(job, -1) and files.exists(f"{self.batch_path('log', job, number)}/_SUCCESS")
        ]
        docs = self._batch_documents(spark, new)
        if docs is None:
            return switch
        touched = self._touched(docs, switch.buckets)
        full = [b for b in touched if len(switch.places.get(b, [])) >= self.generations]
        old = self.view.rows(spark, switch, full)
        merged = self._latest(docs if old is None else docs.unionByName(old, allowMissingColumns=True))
        merged = merged.withColumn(BUCKET, bucket_of(F.col(self.key), switch.buckets))
        upto: dict[str, int] = {}
        for job, number in new:
            upto[job] = max(number, upto.get(job, -1))
        return self.view.write(spark, switch, merged, self.key, touched, full, upto)

    def current(self, spark: SparkSession, source: str | None = None) -> DataFrame:
        """One document per (source, key): the newest version, the later batch on a tie.

        Buckets without news since the last refresh are read as they are; those with news are merged with them.
        """
        switch = self.view.switch(spark)

        def of_source(docs: DataFrame) -> DataFrame:
            return docs if source is None else docs.where(F.col("source") == source)

        if not switch.number:
            return self._restored(self._latest(self._stored(spark, "ok", source).drop("status", "error", "job")))
        news = self._news(spark, switch)
        touched = set() if news is None else set(self._touched(news, switch.buckets))
        mixed = touched | {b for b, generations in switch.places.items() if len(generations) > 1}
        plain = self.view.rows(spark, switch, [b for b in switch.places if b not in mixed])
        parts = [p for p in (news, self.view.rows(spark, switch, sorted(mixed))) if p is not None]
        found = [] if plain is None else [of_source(plain)]
        if parts:
            found.append(self._latest(of_source(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))))
        return self._restored(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found))

    def _matching(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """Documents of these keys, perhaps in several versions: from the buckets of the keys, and from what came after the last refresh."""
        name = keys.columns[0]
        wanted = keys.select(F.col(name).alias("_wanted")).where("_wanted IS NOT NULL")
        few = sorted({r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()})
        many = len(few) > PUSHED_KEYS or not wanted.offset(PUSHED_KEYS + 1).isEmpty()
        switch = self.view.switch(spark)
        if not switch.number:
            parts = [self._stored(spark, "ok").drop("status", "error", "job")]
        else:
            buckets = sorted(r[0] for r in wanted.select(bucket_of(F.col("_wanted"), switch.buckets)).distinct().collect())
            parts = [p for p in (self.view.rows(spark, switch, buckets), self._news(spark, switch)) if p is not None]
            if not parts:
                parts = [self.view.rows(spark, switch, list(switch.places)).limit(0)]

        def chosen(docs: DataFrame) -> DataFrame:
            if many:
                return join_unique(docs, wanted.distinct(), {self.key: "_wanted"}, "left_semi", max_group_rows=None, bound=wanted)
            # Single comparisons reach the Bloom filters, a long list of values would not.
            return docs.where(_any([F.col(self.key) == k for k in few]) if few else F.lit(False))

        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [chosen(p) for p in parts])

    def fetch(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The current documents of the keys in the first column of ``keys``, a table that is cheap to read again."""
        return self._restored(self._latest(self._matching(spark, keys)))

    def parts(self, spark: SparkSession, keys: DataFrame, sources: Sequence[str], fields: Sequence[str]) -> DataFrame:
        """One row per found key: the key, and for each source a struct of ``fields`` of its newest document, null if there
        is none. Newest versions and the join of the sources are one aggregate over the documents of these keys."""
        found = self._matching(spark, keys)
        best = newest_struct([*self.version, "batch_id"], fields)
        rows = found.groupBy(self.key).agg(*[F.max(F.when(F.col("source") == s, best)).alias(s) for s in sources])

        def part(s: str) -> Column:
            return F.when(F.col(s).isNotNull(), F.struct(*[F.col(s)[f].alias(f) for f in fields])).alias(s)

        return rows.select(self.key, *[part(s) for s in sources])

    def prune(self, spark: SparkSession, older_than_seconds: float) -> None:
        """Compaction of a running store: remove the documents of batches that the current ones have taken in, and tables
        of current documents that are not in use, if both were so ``older_than_seconds`` ago. No reader may take longer
        than that. Refused documents and the log stay."""
        now = int(time.time() * 1000)
        files, switch = Files(spark, self.root), self.view.switch(spark)
        for job, upto in switch.upto.items():
            folder = f"{self.root}/data/job={job}"
            for name, changed in files.children(folder):
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= upto and changed <= now - 1000 * older_than_seconds:
                    refused = any(n == "status=failed" for n, _ in files.children(f"{folder}/{name}"))
                    files.delete(f"{folder}/{name}/status=ok" if refused else f"{folder}/{name}")
        self.view.prune(spark, older_than_seconds, now)

    def log(self, spark: SparkSession) -> DataFrame:
        found = spark.read.option("mergeSchema", "true").parquet(self.log_path)
        return found.withColumn("batch_id", F.col("batch_id").cast("bigint")).withColumn("job", F.col("job").cast("string"))

    def compact(self, spark: SparkSession, root: str, upto: int) -> "Store":
        """Write the current documents of all batches up to ``upto`` as one batch of a new store, with the
        refused documents and the log of those batches.

        Meanwhile later batches may be written here; copy or replay them, then switch readers.
        """
        target = Store(root, self.key, self.version, self.sources)
        early = F.col("batch_id") <= upto
        latest = self._latest(self._stored(spark, "ok").where(early).drop("status", "error", "job"))
        latest = latest.withColumn("error", F.lit(None).cast("string")).withColumn("status", F.lit("ok"))
        refused = self._stored(spark, "failed").where(early).drop("job")
        kept = latest.unionByName(refused).withColumn("job", F.lit("compacted")).withColumn("batch_id", F.lit(upto).cast("bigint"))
        target._note_schema(spark, kept.schema)
        kept.write.partitionBy(*FOLDERS).parquet(target.data_path)
        self.log(spark).where(early).write.partitionBy("job", "batch_id").parquet(target.log_path)
        return target


def _any(conditions: list[Column]) -> Column:
    """Their disjunction, as a shallow tree."""
    while len(conditions) > 1:
        conditions = [reduce(or_, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def write_status_counts(log: DataFrame) -> DataFrame:
    """Documents stored and refused per batch and source."""
    return log.groupBy("batch_id", "source").agg(
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(F.col("status") != "ok").alias("failed"),
    )
