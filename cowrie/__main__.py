"""Jobs for ``spark-submit``: raw files and topics to bronze, silver, gold, report and alerts."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from cowrie import session
from cowrie.functions.messages import schema_drift
from cowrie.functions.periods import parse_day
from cowrie.model import COUNTRIES, DATASETS, FACTS, STREAMED
from cowrie.operators import reconcile
from cowrie.plans import bronze, gold, premiums, report, silver
from cowrie.plans.ledger import Ledger
from cowrie.sources import raw_files
from cowrie.sources.lake import Lake
from cowrie.sources.topics import Channel
from cowrie.streaming import alerts
from cowrie.streaming import silver as stream_silver


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cowrie", description=__doc__)
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--layout", type=json.loads, default={}, help='JSON, folders of thin facts: {"loan_repayments": ["event_date"]}')
    parser.add_argument("--shuffle-gb", type=int, help="size of the largest shuffle expected")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="raw files to bronze")
    ingest.add_argument("--raw", help="root folder of the raw files")
    ingest.add_argument("--data-type", required=True, choices=list(DATASETS))
    ingest.add_argument("--country", nargs="+", choices=COUNTRIES, help="some countries; all if left out")
    ingest.add_argument("--date", type=parse_day, help="YYYYMMDD; all days if left out")
    ingest.add_argument("--ensure-table-only", action="store_true")

    refine = jobs.add_parser("silver", help="bronze to silver")
    refine.add_argument("--data-type", required=True, choices=FACTS)
    refine.add_argument("--date", type=parse_day, help="replay one day; else all pending days")
    refine.add_argument("--refresh-current", action="store_true")

    kpi = jobs.add_parser("gold", help="silver to gold")
    kpi.add_argument("--kpi", required=True, choices=list(gold.INDICATORS))
    kpi.add_argument("--refresh-current", action="store_true")
    kpi.add_argument("--null-safe", action="store_true", help="match NULL dimensions when merging")

    regulatory = jobs.add_parser("report", help="regulatory report of one day")
    regulatory.add_argument("--date", type=parse_day, required=True)

    arrived = jobs.add_parser("arrivals", help="what has come and is still to be read, by country, type and day")
    arrived.add_argument("--raw", required=True)
    arrived.add_argument("--data-type", nargs="+", choices=FACTS, default=FACTS)
    arrived.add_argument("--from", dest="first", type=parse_day, required=True)
    arrived.add_argument("--to", dest="last", type=parse_day, required=True)

    compared = jobs.add_parser("reconcile", help="batch silver against stream silver")
    compared.add_argument("--data-type", required=True, choices=STREAMED)

    publish = jobs.add_parser("publish", help="raw files to the raw topic, as they come")
    publish.add_argument("--raw", required=True)
    drift = jobs.add_parser("schema", help="the fields of a topic's messages against the stated columns")
    drift.add_argument("--since", help="end of an earlier reading; from the earliest if left out")
    for job, option, choices in (
        (jobs.add_parser("stream-silver"), "--data-type", STREAMED),
        (jobs.add_parser("stream-alerts"), "--rule", list(alerts.RULES)),
        (publish, "--data-type", STREAMED),
        (drift, "--data-type", STREAMED),
    ):
        job.add_argument(option, required=True, choices=choices)
        job.add_argument("--format", default="kafka", choices=["kafka", "parquet", "text"])
        job.add_argument("--options", type=json.loads, default={}, help="JSON, e.g. servers or root")
        if job is not drift:
            job.add_argument("--checkpoints", required=True)
            job.add_argument("--state-partitions", type=int, help="fixed by the checkpoint's first run")
    return parser


def attend(spark: SparkSession, runs: Ledger, queries: list[tuple[str, StreamingQuery]]) -> None:
    """Waits for a query to end and writes down what its micro-batches did meanwhile."""
    ended = False
    while not ended:
        try:
            ended = spark.streams.awaitAnyTermination(60)
        finally:
            runs.streams(queries)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = session.build(f"cowrie-{args.job}")
    if args.shuffle_gb:
        session.expect_shuffle(spark, args.shuffle_gb << 30)
    lake = Lake(spark, args.lake, args.layout)
    runs, begun = Ledger(lake), time.monotonic()

    def done(name: str, **rows: int | None) -> None:
        runs.batch(f"{args.job} {name}", time.monotonic() - begun, **rows)

    if args.job == "ingest":
        if args.ensure_table_only:
            bronze.ensure_table(spark, lake, args.data_type)
        else:
            load = bronze.ingest(spark, lake, args.raw, args.data_type, args.country, args.date)
            done(args.data_type, rows_in=load.rows_handled + load.rows_rejected, rows_out=load.rows_handled, rejected=load.rows_rejected)
            print(load)
    elif args.job == "silver":
        rows = silver.refresh(lake, args.data_type, args.date, args.refresh_current)
        if args.data_type == "insurance_operations":
            premiums.refresh(lake, alerts.utc_today())
        done(args.data_type, rows_out=rows)
        print("nothing pending" if rows is None else f"{rows} rows refined")
    elif args.job == "gold":
        rows = gold.refresh(lake, args.kpi, args.refresh_current, args.null_safe)
        done(args.kpi, rows_out=rows)
        print("nothing pending" if rows is None else f"{rows} rows computed")
    elif args.job == "report":
        print(f"{report.publish(lake, args.date)} limits breached")
    elif args.job == "arrivals":
        states = bronze.arrival_report(spark, lake, args.raw, args.data_type, args.first, args.last)
        # as many rows as the range has days, countries and types
        for row in states.filter("state <> 'READ'").orderBy("day", "country_code", "dataset").collect():
            print(*row)
    elif args.job == "reconcile":
        dataset = DATASETS[args.data_type]
        streamed = stream_silver.stream_table(args.lake, args.data_type).read(spark)
        found = reconcile.reconcile(lake.silver(args.data_type).read(), streamed, dataset.key, f"{dataset.amounts[0]}_eur")
        found.write.mode("overwrite").parquet(lake.path("gold", f"{args.data_type}_reconciled"))
        stored = spark.read.parquet(lake.path("gold", f"{args.data_type}_reconciled"))
        for row in stored.groupBy("outcome").count().orderBy("outcome").collect():
            print(*row)
    else:
        topics(spark, lake, runs, args)


def topics(spark: SparkSession, lake: Lake, runs: Ledger, args: argparse.Namespace) -> None:
    channel = Channel(args.format, args.options)
    if args.job == "schema":
        dataset = DATASETS[args.data_type]
        end = channel.end(spark, dataset.raw_topic)
        messages = channel.read(spark, dataset.raw_topic, args.since, end)
        for row in schema_drift(messages, dataset.message_columns).orderBy("field").collect():
            print(*row)
        print(f"--since '{end}'")
    elif args.job == "publish":
        dataset = DATASETS[args.data_type]
        folders = raw_files.file_pattern(args.raw, dataset).rpartition("/")[0]
        events = raw_files.event_stream(spark, folders, dataset.columns)
        query = stream_silver.start_publisher(events, dataset, channel, args.checkpoints)
        attend(spark, runs, [(f"publish {dataset.name}", query)])
    elif args.job == "stream-silver":
        queries = stream_silver.start(
            spark, args.data_type, channel, args.lake, args.checkpoints, state_partitions=args.state_partitions
        )
        attend(spark, runs, list(zip((f"stream-silver {args.data_type}", f"dead-letters {args.data_type}"), queries)))
    else:
        query = alerts.start(
            spark, args.rule, channel, premiums.loader(lake, alerts.utc_today), args.checkpoints,
            state_partitions=args.state_partitions,
        )
        attend(spark, runs, [(f"stream-alerts {args.rule}", query)])


if __name__ == "__main__":
    main()
