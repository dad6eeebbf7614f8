"""Command line of the pipelines, for ``spark-submit run_job.py <job> ...``."""

from __future__ import annotations

import argparse
import logging
import os
from datetime import date

from ingotflow.plans import jobs
from ingotflow.schemas import ORDER_SCHEMA_JSON, load_record_schema
from ingotflow.session import create_session
from ingotflow.sources.landing import ANY_AGE
from ingotflow.sources.topic import MAX_OFFSETS_PER_TRIGGER, read_topic
from ingotflow.streaming.sinks import FLUSH_ROWS


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="run_job.py")
    commands = root.add_subparsers(dest="job", required=True)

    def command(name: str, help_text: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help_text)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    for name, target in (("topic-to-landing", "landing"), ("topic-to-bronze", "bronze")):
        sub = command(name, f"stream a topic to {target}", target, "checkpoint")
        sub.add_argument("--servers", default=os.getenv("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092"))
        sub.add_argument("--topic", default=os.getenv("KAFKA_TOPIC", "orders.raw"))
        sub.add_argument("--schema", default=os.getenv("AVRO_SCHEMA_PATH"))
        sub.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER)
        sub.add_argument("--processing-time",
                         help="run on at this interval instead of taking what there is")
        sub.add_argument("--optimize-write", action=argparse.BooleanOptionalAction, default=True,
                         help="size each micro-batch's files, for one shuffle of its rows")
        if target == "landing":
            sub.add_argument("--max-records-per-file", type=int, default=FLUSH_ROWS)
        else:
            sub.add_argument("--compact-every", type=int, default=jobs.COMPACT_EVERY,
                             help="join small files after so many micro-batches; 0: never")

    sub = command("landing-to-bronze", "append landed files to bronze", "landing", "bronze")
    sub.add_argument("--checkpoint", help="remember files here and append only new ones")
    sub.add_argument("--max-bytes", type=int, help="most bytes in a micro-batch of new files")
    sub.add_argument("--max-file-age", default=ANY_AGE,
                     help="leave out new files this much older than the newest one read")
    sub = command("bronze-to-silver", "upsert bronze into silver", "bronze", "silver")
    sub.add_argument("--profile", choices=sorted(jobs.PROFILES), default="file")
    sub.add_argument("--since", type=date.fromisoformat, help="first ingestion date to read")
    sub.add_argument("--source-is-small", action="store_true",
                     help="the rows read are few next to the silver table's")
    sub.add_argument("--count-read", action="store_true",
                     help="log the rows read too; the validity filter is then not pushed down")
    sub.add_argument("--table", help="merge into this catalog table instead, by its own MERGE")
    sub.add_argument("--key-buckets", type=int,
                     help="keep the table's keys in so many buckets; merges then shuffle only their source")
    command("silver-to-gold", "rebuild the gold tables", "silver", "gold")
    return root


def run(args: argparse.Namespace) -> None:
    spark = create_session(args.job)
    try:
        if args.job in ("topic-to-landing", "topic-to-bronze"):
            schema = load_record_schema(spark, args.schema) if args.schema else ORDER_SCHEMA_JSON
            messages = read_topic(spark, args.servers, args.topic, args.max_offsets)
            if args.job == "topic-to-landing":
                jobs.topic_to_landing(messages, args.landing, args.checkpoint, schema,
                                      args.processing_time, args.max_records_per_file,
                                      args.optimize_write)
            else:
                jobs.topic_to_bronze(messages, args.bronze, args.checkpoint, schema,
                                     args.processing_time, args.optimize_write,
                                     args.compact_every or None)
        elif args.job == "landing-to-bronze" and args.checkpoint:
            jobs.new_landing_to_bronze(spark, args.landing, args.bronze, args.checkpoint,
                                       max_bytes=args.max_bytes, max_file_age=args.max_file_age)
        elif args.job == "landing-to-bronze":
            jobs.landing_to_bronze(spark, args.landing, args.bronze)
        elif args.job == "bronze-to-silver":
            jobs.bronze_to_silver(spark, args.bronze, args.silver, args.profile, args.since,
                                  source_is_small=args.source_is_small,
                                  count_read=args.count_read, table=args.table,
                                  key_buckets=args.key_buckets)
        else:
            jobs.silver_to_gold(spark, args.silver, args.gold)
    finally:
        spark.stop()


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    run(parser().parse_args(argv))
