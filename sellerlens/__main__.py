"""The platform's jobs from the command line: ``spark-submit`` or ``python -m sellerlens``.

land      copy a complaint or seller file into the raw layer
ingest    take what a topic (or a folder of messages) holds into the raw layer
pipeline  normalise, aggregate, score and check; optionally publish and export
register  make the raw, refined and curated tables known by name
show      print a report or investigation, or write it as JSON

Scan and shuffle sizes follow the bytes under <base>/raw, or --input-bytes. Scratch tables go to
the folder named in spark.checkpoint.dir, or below <base>/_scratch, and are removed after use.
"""

from __future__ import annotations

import argparse
import posixpath
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from sellerlens.operators.roles import mask_customers
from sellerlens.plans import activity, governance, investigate, reports
from sellerlens.plans.pipeline import PUBLISHED, Run, run_pipeline
from sellerlens.schemas import RAW_TABLES
from sellerlens.session import build_session, size_session
from sellerlens.sources.catalog import Catalog
from sellerlens.sources.files import Lake, export_json, folder_bytes, land_files, read_raw
from sellerlens.sources.scratch import scratch_removed, use_scratch
from sellerlens.streaming.ingest import file_topic, ingest_stream, kafka_topic


@dataclass(frozen=True)
class Asked:
    """What a view may be asked for besides its name."""

    seller: str | None = None
    salt: str | None = None


View = Callable[[Run, Asked], DataFrame]


def _risk(view: Callable[[DataFrame], DataFrame]) -> View:
    return lambda run, _: view(run.read("curated.seller_risk"))


def _facts(run: Run) -> list[DataFrame]:
    return [run.read(f"refined.{t}") for t in ("orders", "returns", "complaints")]


def _sales(run: Run, seller: str | None) -> list[DataFrame]:
    """Orders and returns, of one seller from the files that have any."""
    names = ("refined.orders", "refined.returns")
    return [run.read(n) if seller is None else run.read_seller(n, seller) for n in names]


VIEWS: dict[str, View] = {
    "sellers": _risk(lambda risk: risk),
    "high-risk": _risk(investigate.high_risk),
    "suspicious-returns": _risk(investigate.suspicious_returns),
    "high-severity": _risk(investigate.repeated_high_severity),
    "unverified-risky": _risk(investigate.unverified_risky),
    "returns-and-complaints": _risk(investigate.returns_and_complaints),
    "top10": _risk(investigate.top_sellers),
    "headlines": _risk(reports.headline_kpis),
    "regions": _risk(reports.region_cards),
    "region-members": _risk(lambda risk: reports.region_members(risk).orderBy("region", "place")),
    "priorities": _risk(lambda risk: reports.priority_list(risk).orderBy("priority")),
    "score-chart": _risk(reports.seller_score_series),
    "region-chart": _risk(reports.region_index_series),
    "scatter": _risk(investigate.return_complaint_scatter),
    "fraud": lambda run, _: reports.fraud_table(run.read("curated.fraud_patterns")),
    "latest-fraud": lambda run, _: investigate.latest_fraud(run.read("curated.fraud_patterns")),
    "complaints": lambda run, _: investigate.complaint_breakdown(run.read("refined.complaints")),
    "daily-volume": lambda run, _: investigate.daily_volume(run.read("refined.orders")),
    "profile": lambda run, asked: investigate.seller_profile(
        run.read("curated.seller_risk"), run.read("curated.fraud_patterns"), asked.seller
    ),
    "customers": lambda run, asked: activity.customer_activity(
        *_sales(run, asked.seller), asked.seller, asked.salt
    ),
    "masked-orders": lambda run, asked: mask_customers(run.read("refined.orders"), asked.salt),
    "layers": lambda run, _: activity.layer_counts(
        read_raw(run.spark, run.lake, "orders"),
        run.read("refined.orders"),
        run.read("curated.seller_risk"),
    ),
    "events": lambda run, _: activity.event_counts(
        *[read_raw(run.spark, run.lake, t) for t in ("orders", "returns", "complaints")]
    ),
    "quality": lambda run, _: governance.quality_report(*_facts(run)),
    "access": lambda run, _: governance.access_report({n: run.read(n) for n in PUBLISHED}),
}


def _salt(spark: SparkSession, path: str | None) -> str | None:
    """The first line of a file that only trusted jobs can read."""
    return spark.read.text(path).first().value if path else None


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sellerlens", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        added.add_argument("--base", required=True, help="folder that holds the layers")
        added.add_argument("--input-bytes", type=int, help="size the job for so much raw data")
        return added

    land = job("land")
    land.add_argument("--table", choices=RAW_TABLES, required=True)
    land.add_argument("--source", required=True)

    ingest = job("ingest")
    ingest.add_argument("--table", choices=RAW_TABLES, required=True, help="also the topic")
    where = ingest.add_mutually_exclusive_group(required=True)
    where.add_argument("--kafka", metavar="SERVERS")
    where.add_argument("--folder", help="a folder of JSON lines instead of a topic")
    ingest.add_argument("--max-per-trigger", type=int)

    pipeline = job("pipeline")
    pipeline.add_argument("--as-of", help="reference time, default now")
    pipeline.add_argument("--publish", action="store_true", help="name the tables in the catalog")
    pipeline.add_argument("--keep-runs", type=int, help="delete all but so many of the last runs")
    pipeline.add_argument(
        "--grace-hours", type=float, default=24, help="never delete runs that began within so many hours"
    )
    pipeline.add_argument("--export", metavar="PATH", help="write curated sellers as JSON")

    register = job("register")
    register.add_argument("--prefix", default="", help="of the database names")

    show = job("show")
    show.add_argument("view", choices=sorted(VIEWS))
    show.add_argument("--seller")
    show.add_argument("--salt-file", help="its first line salts masked ids")
    show.add_argument("--json", metavar="PATH", help="write all rows instead of a preview")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"sellerlens-{args.job}")
    lake = Lake(args.base)
    raw_bytes = folder_bytes(spark, f"{lake.root}/raw") + folder_bytes(spark, f"{lake.root}/raw_stream")
    size_session(spark, raw_bytes if args.input_bytes is None else args.input_bytes)
    use_scratch(spark, f"{lake.root}/_scratch")
    with scratch_removed(spark):
        _run_job(spark, lake, args)


def _run_job(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    if args.job == "land":
        file = posixpath.basename(args.source.rstrip("/"))
        land_files(spark, args.source, posixpath.join(lake.path("raw", args.table), file))
    elif args.job == "ingest":
        if args.kafka:
            messages = kafka_topic(spark, args.kafka, args.table, args.max_per_trigger)
        else:
            messages = file_topic(spark, args.folder, args.max_per_trigger)
        ingest_stream(
            messages, lake.stream_path(args.table), lake.path("offsets", args.table)
        ).awaitTermination()
    elif args.job == "pipeline":
        catalog = Catalog(spark) if args.publish else None
        run_pipeline(
            spark,
            args.base,
            args.as_of,
            catalog=catalog,
            export_path=args.export,
            keep_runs=args.keep_runs,
            grace=timedelta(hours=args.grace_hours),
        ).show(truncate=False)
    elif args.job == "register":
        catalog = Catalog(spark, prefix=args.prefix)
        catalog.register_raw(lake)
        catalog.register_refined(lake)
        catalog.register_curated(lake)
        catalog.list_tables().show(200, truncate=False)
    else:
        view = VIEWS[args.view](Run(spark, lake), Asked(args.seller, _salt(spark, args.salt_file)))
        if args.json:
            export_json(view, args.json)
        else:
            view.show(truncate=False)


if __name__ == "__main__":
    main()
