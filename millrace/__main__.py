"""The jobs as commands, for spark-submit or ``python -m millrace``.

    lookup    --file patients.txt --schema patient_info --key patientID --out DIR
    publish   --source billing_cost=billing.txt --source ... --out DIR [--rows N]
    index     --messages DIR | --servers HOST:PORT --topics a,b   --store DIR --checkpoint DIR [--refresh-every N] [--once]
    converge  --store DIR --lookup DIR --out DIR --checkpoint DIR [--registry TEXT] [--wait "2 days"] [--once]
    maintain  --store DIR [--older-than SECONDS]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions.jsonio import typed_value
from millrace.plans.convergence import document_store, message_files, publish, start_converging, start_indexing
from millrace.schemas import RECORD_FIELDS, SCHEMAS, health_registry
from millrace.sinks.lookup import load_lookup
from millrace.sources.delimited import good_rows, read_delimited
from millrace.sources.streams import read_topics
from millrace.spec import Registry, RunConfig


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        sub.add_argument("--date-format", default="MM-dd-yyyy")
        return sub

    command("lookup", "file", "schema", "key", "out")
    sub = command("publish", "out")
    sub.add_argument("--source", action="append", required=True, help="name=path")
    sub.add_argument("--rows", type=int)
    sub.add_argument("--key-column", help="the files' own key column; without it keys are made up")
    for sub in (command("index", "store", "checkpoint"), command("converge", "store", "lookup", "out", "checkpoint")):
        sub.add_argument("--once", action="store_true", help="process what is there and end")
        sub.add_argument("--interval", default=RunConfig().chunk_timeout)
        sub.add_argument("--messages")
        sub.add_argument("--servers")
        sub.add_argument("--topics", help="topic,topic or topic=source,topic=source")
        sub.add_argument("--lookup-source", default=RunConfig().lookup_source)
        sub.add_argument("--lookup-key", default=RunConfig().lookup_key)
        sub.add_argument("--registry", help="source|schema~source|schema")
        sub.add_argument("--refresh-every", type=int, default=10, help="micro-batches between refreshes of the current documents")
        sub.add_argument("--wait", help="report keys that stay incomplete for so long, and forget them")
        sub.add_argument("--delay", default="0 seconds", help="how late commits may come, with --wait")
        sub.add_argument("--memory", default="7 days", help="how long keys are remembered after their wait")
    sub = command("maintain", "store")
    sub.add_argument("--older-than", type=float, help="remove what current documents replaced so many seconds ago")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"millrace {args.command}").getOrCreate()
    if args.command == "lookup":
        rows = good_rows(read_delimited(spark, args.file))
        typed = [typed_value(F.col(f.name), f.dataType, args.date_format).alias(f.name) for f in SCHEMAS[args.schema]]
        load_lookup(rows.select(*typed), args.out, args.key)
    elif args.command == "publish":
        files = dict(s.split("=", 1) for s in args.source)
        publish(spark, files, args.out, args.rows, key=args.key_column).show(truncate=False)
    elif args.command == "index":
        if args.messages:
            messages = message_files(spark, args.messages)
        else:
            topics = dict((t.split("=", 1) * 2)[:2] for t in args.topics.split(","))
            messages = read_topics(spark, args.servers, list(topics), sources=topics)
        config = RunConfig().override(chunk_timeout=args.interval)
        sources = Registry.parse(args.registry, SCHEMAS).names if args.registry else None
        start_indexing(
            messages, args.store, args.checkpoint, config, args.once, sources, args.refresh_every
        ).awaitTermination()
    elif args.command == "maintain":
        store = document_store(args.store)
        store.refresh(spark)
        if args.older_than is not None:
            store.prune(spark, args.older_than)
    else:
        options = {"date_format": args.date_format}
        registry = Registry.parse(args.registry, SCHEMAS, **options) if args.registry else health_registry(**options)
        config = RunConfig().override(
            chunk_timeout=args.interval, lookup_source=args.lookup_source, lookup_key=args.lookup_key
        )
        fields = {s: RECORD_FIELDS.get(s, s) for s in ["patient_info", *registry.names]}
        start_converging(
            spark, args.store, registry, args.lookup, fields, args.out, args.checkpoint, config, args.once,
            args.wait, args.delay, args.memory,
        ).awaitTermination()


if __name__ == "__main__":
    main()
