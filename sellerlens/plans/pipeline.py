"""Raw to curated, each layer written before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from sellerlens.operators.fraud import fraud_patterns
from sellerlens.operators.metrics import seller_aggregates
from sellerlens.operators.normalize import NORMALIZERS, normalize_orders
from sellerlens.operators.scoring import AsOf, score, seller_risk
from sellerlens.plans.activity import count_of
from sellerlens.policy import DEFAULT_POLICY, RiskPolicy
from sellerlens.schemas import RAW_TABLES
from sellerlens.sources.catalog import Catalog
from sellerlens.sources.files import (
    LAID_OUT,
    Lake,
    current,
    export_json,
    finish_run,
    forget_runs,
    new_run,
    publish_gate,
    read_ranged,
    read_raw,
    read_table,
    write_laid_out,
    write_table,
)

# Sorted by seller inside each file: drill-downs into one seller skip the rest of it.
CLUSTER_BY = {"complaints": ("seller_id",)}
CURATED = ("seller_risk", "fraud_patterns")
PUBLISHED = (
    "curated.seller_risk",
    "curated.fraud_patterns",
    "refined.orders",
    "refined.returns",
    "refined.complaints",
    "refined.sellers",
)
FACTS = ("refined.orders", "refined.returns", "refined.complaints")


def side_by_side(
    spark: SparkSession, work: Callable[[str], object], tables: Iterable[str]
) -> None:
    """Run independent jobs at the same time, so that one's last tasks overlap the next's first.

    Each thread gets its own copy of the caller's job group and scheduler pool.
    """
    wanted = list(tables)
    with ThreadPoolExecutor(max_workers=max(1, len(wanted))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work), t) for t in wanted]
    for job in running:
        job.result()


@dataclass(frozen=True)
class Run:
    """One pipeline run: where, as of when, under which policy.

    Over a lake that names no run, refined and curated tables are those of the run that was the last finished
    one when first asked for. It stays that one: what is read together belongs together, whatever finishes meanwhile.
    """

    spark: SparkSession
    lake: Lake
    as_of: AsOf = None
    policy: RiskPolicy = DEFAULT_POLICY

    @cached_property
    def place(self) -> Lake:
        return current(self.spark, self.lake)

    def read(self, name: str) -> DataFrame:
        layer, table = name.split(".")
        return read_table(self.spark, self.place, layer, table)

    def read_seller(self, name: str, seller_id: str) -> DataFrame:
        """One seller's rows of a fact table that is laid out by seller, from the files that have any."""
        layer, table = name.split(".")
        return read_ranged(self.spark, self.place, layer, table, seller_id)

    def refine(self, table: str, raw: DataFrame | None = None) -> None:
        raw = read_raw(self.spark, self.lake, table) if raw is None else raw
        if table == "orders":
            clean = normalize_orders(raw, self.policy)
        else:
            clean = NORMALIZERS[table](raw)
        by = LAID_OUT.get(f"refined.{table}")
        if by:
            write_laid_out(clean, self.place, "refined", table, by)
        else:
            write_table(clean, self.place, "refined", table, CLUSTER_BY.get(table, ()))

    def aggregate(self) -> None:
        facts = [self.read(f"refined.{t}") for t in ("sellers", "orders", "returns", "complaints")]
        write_table(seller_aggregates(*facts), self.place, "refined", "seller_aggregates")

    def curate(self) -> None:
        """Both curated tables from the aggregates, which hold one row per seller."""
        scored = score(self.read("refined.seller_aggregates"), self.as_of, self.policy)
        write_table(seller_risk(scored), self.place, "curated", "seller_risk")
        write_table(
            fraud_patterns(scored, self.as_of, self.policy), self.place, "curated", "fraud_patterns"
        )

    def gate(self) -> DataFrame:
        """Raises unless the curated tables exist, have rows and the right shape.

        An empty fraud table is a good result, so only its shape is checked.
        """
        risk = publish_gate(self.spark, self.place, "curated", "seller_risk")
        fraud = publish_gate(
            self.spark, self.place, "curated", "fraud_patterns", rows_required=False
        )
        return risk.unionByName(fraud)

    def transform(self) -> DataFrame:
        """Normalise, aggregate, score and check; returns the gate's rows."""
        side_by_side(self.spark, self.refine, RAW_TABLES)
        self.aggregate()
        self.curate()
        return self.gate()

    def publish(self, catalog: Catalog, copy_facts: bool = False) -> DataFrame:
        """Make refined and curated tables known by name; one row per table with its rows.

        Names show the files of the run, which later runs leave alone, and change all at once. ``copy_facts``
        copies the facts first and shows the copies, for a run whose own files may go.
        """
        place, copies = self.place, {}
        if copy_facts:
            folder = f"{catalog.log}_copies/{uuid.uuid4().hex}"
            for name in FACTS:
                copies[name] = f"{folder}/{name}"
                self.read(name).write.parquet(copies[name])
        catalog.show_run(place, PUBLISHED, copies)
        return published_counts(catalog)

    def export(self, path: str) -> str:
        return export_json(self.read("curated.seller_risk"), path)


def published_counts(catalog: Catalog) -> DataFrame:
    pinned = catalog.pinned()
    counts = [count_of(pinned.table(name), name) for name in PUBLISHED]
    return reduce(DataFrame.unionByName, counts).withColumnsRenamed(
        {"label": "table_name", "n": "row_count"}
    )


def run_pipeline(
    spark: SparkSession,
    base: str,
    as_of: AsOf = None,
    policy: RiskPolicy = DEFAULT_POLICY,
    catalog: Catalog | None = None,
    export_path: str | None = None,
    keep_runs: int | None = None,
    grace: timedelta = timedelta(0),
) -> DataFrame:
    """The nightly run over ``base``: transform and check, then publish and export if asked.

    The run writes to a folder of its own. Only when its gate has passed does it become the current
    one and do names move to it, all in one step; until then, and if it fails, everything answers with the run
    before. ``keep_runs`` deletes all but that many of the last runs, those that began within ``grace``, and the one
    that names show; off by default.
    """
    lake = new_run(Lake(base))
    run = Run(spark, lake, as_of, policy)
    checked = run.transform()
    finish_run(spark, lake)
    if catalog is not None:
        run.publish(catalog)
    if export_path is not None:
        run.export(export_path)
    if keep_runs is not None:
        held = [catalog.shown_run()] if catalog is not None else []
        gone = forget_runs(spark, lake, keep_runs, grace, held)
        if catalog is not None:
            catalog.drop_runs(gone)
    return checked
