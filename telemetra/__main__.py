"""Jobs for ``spark-submit``: ``python -m telemetra <job> --root <folder> ...``"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from telemetra import compaction, rules
from telemetra.operators.forest import ForestSpec
from telemetra.operators.registry import current_model
from telemetra.plans.backfill import run_backfill
from telemetra.plans.daily import run_summary, run_training
from telemetra.session import configure
from telemetra.sinks.batches import kafka_sink, kafka_sink_options
from telemetra.sources.messages import ANOMALY_TOPIC, PROCESSED_TOPIC, kafka_source_options, read_message_stream
from telemetra.streaming.etl import anomaly_messages, await_any, file_sinks, processed_messages, run_etl
from telemetra.streaming.scoring import run_scoring
from telemetra.tables import Store, Table


# Most messages, or message files, of a micro-batch unless told otherwise.
KAFKA_BATCH, FILE_BATCH = 20_000_000, 1_000


def ingest(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Streaming ETL from Kafka, back to Kafka and into the tables; or from message files."""
    trigger = {"processingTime": args.every} if args.every else None
    sinks = file_sinks(store, args.messages, rebalance=True, hourly=True)
    if args.servers:
        limit = {"maxOffsetsPerTrigger": str(args.batch_limit or KAFKA_BATCH)}
        stream = read_message_stream(spark, **kafka_source_options(args.servers), **limit)
        sinks += [
            kafka_sink(kafka_sink_options(args.servers, PROCESSED_TOPIC), processed_messages),
            kafka_sink(kafka_sink_options(args.servers, ANOMALY_TOPIC), anomaly_messages),
        ]
    else:
        stream = read_message_stream(spark, "parquet", args.path, maxFilesPerTrigger=str(args.batch_limit or FILE_BATCH))
    query = run_etl(stream, sinks, args.checkpoint, trigger, once_within=args.once_within)
    if args.every:
        await_any(spark)
    else:
        query.awaitTermination()


def summary(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    run_summary(spark, store, args.as_of, args.from_hours).show(truncate=False)


def train(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    trained = run_training(spark, store, args.model_id, args.as_of)
    print(f"{args.model_id}: health {trained.health_score:.3f}, {trained.decision}")


def backfill(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    spec = ForestSpec(contamination=args.contamination)
    ranges = list(zip(args.start, args.end, strict=True))
    run_backfill(spark, store, ranges, args.as_of, args.min_rows, spec).show(truncate=False)


def score(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Score message files by the model in production; rows go to a folder."""
    to = Table("sensor_scores", args.to, store.scores.schema, store.scores.partitions)
    stream = read_message_stream(spark, "parquet", args.path, maxFilesPerTrigger=str(FILE_BATCH))
    if current_model(store.models.read(spark), store.promotions.read(spark)).first() is None:
        raise SystemExit("no model has been promoted yet")
    query = run_scoring(stream, store, args.checkpoint, {"processingTime": args.every} if args.every else None, to)
    query.awaitTermination()


def compact(spark: SparkSession, store: Store, args: argparse.Namespace) -> None:
    """Pack the batches of closed dates into few files; earlier packed batches are removed first."""
    before = date.fromisoformat(args.before)
    for table in (store.readings, store.anomalies, store.hourly, store.scores):
        gone = compaction.sweep(spark, table)
        done = compaction.compact(spark, table, before)
        print(f"{table.name}: {len(done)} dates packed, {len(gone)} batch folders removed")
    store.summary.vacuum(spark)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="telemetra")
    jobs = top.add_subparsers(required=True)

    def job(function, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(function.__name__, help=(function.__doc__ or "").split(";")[0])
        sub.set_defaults(job=function)
        for name in ("--root", *required):
            sub.add_argument(name, required=True)
        return sub

    source = job(ingest, "--checkpoint")
    one_of = source.add_mutually_exclusive_group(required=True)
    one_of.add_argument("--servers", help="Kafka bootstrap servers")
    one_of.add_argument("--path", help="folder of message files")
    source.add_argument("--messages", help="folder for outgoing message files")
    source.add_argument("--batch-limit", type=int, help="most messages, or files, of a micro-batch")
    source.add_argument("--every", help="trigger interval, as '1 minute'; without it, stop when all is read")
    source.add_argument("--once-within", help="drop repeats of a sensor's message within this time of the watermark, as '1 hour'")
    job(summary, "--as-of").add_argument("--from-hours", action="store_true", help="from statistics stored by hour")
    job(train, "--as-of", "--model-id")
    job(score, "--path", "--checkpoint", "--to").add_argument("--every", help="trigger interval; without it, stop when all is read")
    job(compact, "--before")
    past = job(backfill, "--as-of")
    past.add_argument("--start", action="append", required=True, help="repeatable, with as many --end")
    past.add_argument("--end", action="append", required=True)
    past.add_argument("--min-rows", type=int, default=rules.MIN_TRAINING_ROWS)
    past.add_argument("--contamination", type=float, default=rules.CONTAMINATION)
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = configure(SparkSession.builder.appName("telemetra")).getOrCreate()
    store = Store(args.root)
    store.create(spark)
    args.job(spark, store, args)


if __name__ == "__main__":
    main()
