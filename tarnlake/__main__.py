"""The jobs from the command line: ``spark-submit ... -m tarnlake`` or ``python -m tarnlake``."""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tarnlake.operators import assert_not_empty, latest_batch
from tarnlake.plans import build_report, clean_file, load_dimension, save_report
from tarnlake.schemas import LEDGER, METHOD_COLUMNS, METHODS, SAMPLE_COLUMNS, SAMPLES, SITES
from tarnlake.session import configure, size_shuffles
from tarnlake.sources import (
    create_schema_if_absent,
    create_table_if_absent,
    delimited_stream,
    kafka_stream,
    message_stream,
    read_delimited,
    read_table,
)
from tarnlake.streaming import BatchStore, ProgressLog, cut_for_replay, drain, finish, ingest, publish_ledger, replay


def create_tables(spark, args):
    create_schema_if_absent(spark, args.schema, args.location)
    empty = {"sites": SITES, "methods": METHODS} | ({} if args.store else {"samples": SAMPLES, "ledger": LEDGER})
    for name, schema in empty.items():
        create_table_if_absent(spark, f"{args.schema}.{name}", schema)
    if args.store:
        publish(spark, argparse.Namespace(store=args.store, table=f"{args.schema}.samples", ledger=f"{args.schema}.ledger"))


def publish(spark, args):
    store = BatchStore(args.store)
    publish_ledger(spark, store, args.ledger)
    store.publish(spark, args.table, SAMPLES)


def replay_rows(spark, args):
    as_text = StructType([StructField(c, StringType()) for c in SAMPLE_COLUMNS])
    if args.rows_per_batch:
        rows = cut_for_replay(read_delimited(spark, args.source, as_text, args.sep, missing_value_texts=True), args.rows_per_batch)
    else:
        rows = delimited_stream(spark, args.source, as_text, args.sep, args.files_per_batch)
    fmt = "kafka" if args.servers else "text"
    query = replay(rows, args.target, args.checkpoint, args.interval, fmt, args.servers)
    (finish if args.interval else drain)(query, args.timeout)


def ingest_messages(spark, args):
    if args.servers:
        messages = kafka_stream(spark, args.servers, args.source, max_per_batch=args.messages_per_batch)
    else:
        messages = message_stream(spark, args.source)
    log = ProgressLog(spark, args.progress) if args.progress else None
    if log:
        spark.streams.addListener(log)
    try:
        drain(ingest(messages, SAMPLES, BatchStore(args.store), args.checkpoint, interval=args.interval, published=args.table), args.timeout)
    finally:
        if log:
            log.close()


def compact_ledger(spark, args):
    BatchStore(args.store).compact_ledger(spark)


def compact(spark, args):
    store = BatchStore(args.store)
    folded = store.compact(spark, SAMPLES, file_bytes=args.file_mb << 20)
    store.compact_ledger(spark)
    if args.table:
        store.publish(spark, args.table, SAMPLES)
    removed = store.vacuum(spark, args.grace_hours * 3600)
    print(f"{folded} batches folded, {len(removed)} folders removed")


def rollback(spark, args):
    print(f"{BatchStore(args.store).rollback(spark, args.version)} batches withdrawn")


def load_dimensions(spark, args):
    load_dimension(spark, args.methods_file, METHODS, args.methods, end_year_column="END_YEAR")
    load_dimension(spark, args.sites_file, SITES, args.sites)


def report(spark, args):
    store = BatchStore(args.store)
    size_shuffles(spark, store.rows, *(t for t in (args.sites, args.methods) if "/" in t))
    ledger = store.ledger(spark)
    assert_not_empty(ledger, "ledger")
    result = build_report(
        store.latest_slice(spark, SAMPLES, "DATE_SMP").select(*SAMPLE_COLUMNS),
        read_table(spark, args.sites),
        read_table(spark, args.methods).select(*METHOD_COLUMNS),
        collapse_samples=not args.all_samples,
        spread=int(args.spread) if args.spread else None,
    )
    version = latest_batch(ledger).first()["version_id"]
    folder = args.reconciliation or f"{args.joined.rstrip('/')}-reconciliation"
    metrics = save_report(result, args.joined, args.metrics, version, folder)
    assert_not_empty(metrics, args.metrics)
    missing = read_table(spark, f"{folder}/version_id={version}", result.reconciliation.schema)
    missing.groupBy("missing_in").count().show()


def clean(spark, args):
    profile = clean_file(spark, args.source, args.target, args.sep)
    profile.show(profile.count(), truncate=False)


def parser():
    top = argparse.ArgumentParser(prog="tarnlake", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def job(name, run, *required, **optional):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            kind = int if option in ("timeout", "files_per_batch", "rows_per_batch", "messages_per_batch", "file_mb", "grace_hours") else str
            sub.add_argument(f"--{option.replace('_', '-')}", default=default, type=kind)
        return sub

    stream = {"servers": None, "interval": None, "timeout": None}
    job("create-tables", create_tables, "schema", location=None, store=None).description = (
        "Make empty catalog tables; load-dimensions and report take their names in place of folders. "
        "With a store, its batches and its ledger can be queried as samples and ledger."
    )
    job("publish", publish, "store", "table", "ledger")
    job("compact", compact, "store", table=None, file_mb=128, grace_hours=24)
    job("rollback", rollback, "store", "version")
    job("clean", clean, "source", "target", sep=";")
    job("replay", replay_rows, "source", "target", "checkpoint", sep=",", files_per_batch=None, rows_per_batch=None, **stream)
    job("ingest", ingest_messages, "source", "store", "checkpoint", progress=None, messages_per_batch=None, table=None, **stream)
    job("compact-ledger", compact_ledger, "store")
    job("load-dimensions", load_dimensions, "methods-file", "sites-file", "methods", "sites")
    job("report", report, "store", "sites", "methods", "joined", "metrics", reconciliation=None, spread=None).add_argument(
        "--all-samples", action="store_true", help="yearly means over all samples of a site"
    )
    return top


def main(argv=None, spark=None):
    args = parser().parse_args(argv)
    args.run(configure(spark or SparkSession.builder.appName("tarnlake").getOrCreate()), args)


if __name__ == "__main__":
    main()
