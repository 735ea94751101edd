"""Refined and curated tables built from one scale-factor folder, each at most once a session."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from sellerlens.plans.pipeline import PUBLISHED, Run, side_by_side
from sellerlens.session import pin_utc, widen_shuffles
from sellerlens.sources.catalog import Catalog
from sellerlens.sources.files import Lake, export_json
from sellerlens.sources.scratch import scratch_path
from sellerlens.sources.starschema import AS_OF, RAW, source_bytes

# JSON repeats its field names and much else: a sixth or less of it is written.
LANDED_AS = "gzip"

_lock = threading.RLock()
_marts: dict[tuple[str, str], Marts] = {}


class Marts:
    """Layer tables in the shared scratch folder, written when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run = Run(spark, Lake(scratch_path(spark, "marts")), AS_OF)
        self.source_bytes = source_bytes(spark, sf_dir)
        self._raw: dict[str, DataFrame] = {}
        self._done: set[str] = set()

    def raw(self, table: str) -> DataFrame:
        """The raw table's plan; kept, because each new one reads the files' footers again."""
        if table not in self._raw:
            self._raw[table] = RAW[table](self.spark, self.sf_dir)
        return self._raw[table]

    def table(self, name: str) -> DataFrame:
        with _lock:
            self._build(name)
        return self.run.read(name)

    def landed(self, *tables: str) -> Lake:
        """The raw tables as compressed JSON lines, all four or those that are named."""
        with _lock:
            missing = [t for t in tables or RAW if f"landed.{t}" not in self._done]
            side_by_side(self.spark, self._land, missing)
            self._done.update(f"landed.{t}" for t in missing)
        return self.run.lake

    def _land(self, name: str) -> None:
        export_json(self.raw(name), self.run.lake.path("raw", name), LANDED_AS)

    def published(self) -> Catalog:
        """Refined and curated tables in a catalog of their own."""
        catalog = self.catalog("m")
        with _lock:
            if "published" not in self._done:
                for name in PUBLISHED:
                    self._build(name)
                self.run.publish(catalog)
                self._done.add("published")
        return catalog

    def catalog(self, prefix: str) -> Catalog:
        """Database names and folder that no other source folder shares."""
        owner = self.run.lake.base.rsplit("-", 1)[-1][:8]
        folder = f"{self.run.lake.base}/{prefix}-warehouse"
        return Catalog(self.spark, prefix=f"{prefix}{owner}_", location=folder)

    def _refine(self, table: str) -> None:
        self.run.refine(table, self.raw(table))

    def _build(self, name: str) -> None:
        if name in self._done:
            return
        layer, table = name.split(".")
        if layer == "curated":
            self._build("refined.seller_aggregates")
            self.run.curate()
            self._done.update({"curated.seller_risk", "curated.fraud_patterns"})
        elif table == "seller_aggregates":
            missing = [t for t in RAW if f"refined.{t}" not in self._done]
            side_by_side(self.spark, self._refine, missing)
            self._done.update(f"refined.{t}" for t in missing)
            self.run.aggregate()
        else:
            self._refine(table)
        self._done.add(name)


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    pin_utc(spark)
    key = (spark.conf.get("spark.app.id"), sf_dir)
    with _lock:
        if key not in _marts:
            _marts[key] = Marts(spark, sf_dir)
        # Each time: the session may have been set up anew between two queries.
        widen_shuffles(spark, _marts[key].source_bytes)
        return _marts[key]
