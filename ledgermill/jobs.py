"""Command line of the lake's jobs, e.g. for ``spark-submit``.

    python -m ledgermill.jobs --lake s3a://bucket/lake ingest --servers broker:9092
    python -m ledgermill.jobs --lake s3a://bucket/lake day --process-date 2024-01-30

``day`` runs refine, check and, where the gate is open, gold. ``check``, ``day``, ``gate`` and
``freshness`` end with status 1 when the answer is no.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from ledgermill import schemas
from ledgermill.operators import quality
from ledgermill.plans import daily
from ledgermill.session import build_session
from ledgermill.sources import transport
from ledgermill.streaming import flows
from ledgermill.workspace import scratch


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="ledgermill")
    main.add_argument("--lake", required=True, help="folder of the lake")
    jobs = main.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="messages to bronze, continuously")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker addresses")
    source.add_argument("--files", help="folder of message files instead of a broker")
    ingest.add_argument("--topic", default=schemas.TOPIC)
    ingest.add_argument("--starting-offsets", default="latest")
    ingest.add_argument("--trigger-interval", default=flows.TRIGGER)
    ingest.add_argument("--once", action="store_true", help="stop when all input is read")
    ingest.add_argument("--max-offsets", type=int, help="messages of one trigger; all by default")
    ingest.add_argument("--accept-data-loss", action="store_true",
                        help="go on where messages expired unread")

    today = dt.datetime.now(dt.timezone.utc).date().isoformat()
    for name, text in {
        "refine": "bronze to silver and quarantine", "check": "quality metrics of a day",
        "gold": "gold snapshots of a day", "day": "refine, check, gold",
        "gate": "may the day proceed?",
    }.items():
        job = jobs.add_parser(name, help=text)
        job.add_argument("--process-date", default=today)
        if name in ("gold", "day"):
            job.add_argument("--from-states", action="store_true",
                             help="customers from daily states instead of the ledger")
            job.add_argument("--buckets", type=int,
                             help="keep daily states in so many buckets of customers")
        if name in ("check", "day"):
            job.add_argument("--as-of", help="moment of checking; now, or the end of a past day")
            job.add_argument("--threshold", action="append", default=[], metavar="CHECK=RATE",
                             type=threshold, help="least pass rate of a check")
    fresh = jobs.add_parser("freshness", help="has bronze grown within two hours?")
    fresh.add_argument("--as-of", help="moment of checking, now by default")
    return main


def threshold(text: str) -> tuple[str, float]:
    name, _, rate = text.partition("=")
    if name not in quality.CHECKS:
        raise argparse.ArgumentTypeError(f"checks are {', '.join(quality.CHECKS)}")
    return name, float(rate)


def ingest(spark: SparkSession, lake: daily.Lake, options: argparse.Namespace) -> None:
    if options.servers:
        messages = transport.kafka_stream(
            spark, options.servers, options.topic, options.starting_offsets,
            options.max_offsets, not options.accept_data_loss)
    else:
        messages = transport.file_stream(spark, options.files)
    bronze, checkpoint = transport.bronze_project(messages), lake.path("_checkpoints", "bronze")
    if options.once:
        flows.run_available(spark, flows.bronze_sink(bronze, checkpoint), lake.bronze)
    else:
        flows.start_bronze(
            bronze, lake.bronze, checkpoint, options.trigger_interval).awaitTermination()


def run(spark: SparkSession, arguments: list[str]) -> int:
    options = parser().parse_args(arguments)
    lake = daily.Lake(options.lake)
    with scratch(spark):
        if options.job == "ingest":
            ingest(spark, lake, options)
        elif options.job == "refine":
            print(json.dumps(daily.refine_day(spark, lake, options.process_date)))
        elif options.job == "check":
            passed = daily.check_day(
                spark, lake, options.process_date, options.as_of, dict(options.threshold))
            return 0 if passed else 1
        elif options.job == "gold":
            daily.gold_day(spark, lake, options.process_date, options.from_states,
                           options.buckets)
        elif options.job == "day":
            result = daily.run_day(
                spark, lake, options.process_date, options.as_of, dict(options.threshold),
                options.from_states, options.buckets)
            print(json.dumps(result))
            return 0 if result["gate_passed"] else 1
        elif options.job == "gate":
            return 0 if daily.gate_open(spark, lake, options.process_date) else 1
        else:
            return 0 if daily.bronze_is_fresh(spark, lake, options.as_of) else 1
    return 0


if __name__ == "__main__":
    sys.exit(run(build_session(), sys.argv[1:]))
