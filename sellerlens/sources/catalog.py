"""Layer databases and named tables over the session catalog."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.schemas import LAYERS, ddl, same_shape, schema, tables
from sellerlens.sources import pointers
from sellerlens.sources.files import RUN_LAYERS, Lake, current

# Databases of the tables that the names are views of.
RAW_PARTS, RUNS = "raw_parts", "run_parts"
# Between the moment and the run of a log entry.
_BY = "="


def _quoted(path: str) -> str:
    """A path as a SQL string literal."""
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


class Catalog:
    """One database per layer, whose names are views.

    The refined and curated names show one run of the pipeline, all the same one: which, stands in one log.
    ``prefix`` keeps several installations apart in one metastore; ``location`` puts managed
    tables under a folder other than the session's warehouse.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", location: str | None = None):
        self.spark = spark
        self.prefix = prefix
        self.location = location

    def _run(self, statement: str) -> None:
        self.spark.sql(statement)

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, table: str) -> str:
        """``curated.seller_risk`` as the catalog knows it."""
        layer, short = table.split(".")
        return f"`{self.database(layer)}`.`{short}`"

    def ensure_layers(self) -> None:
        for layer in LAYERS:
            self._ensure_database(layer)

    def register_raw(self, lake: Lake) -> None:
        """Each raw table by name: a view over the landed files and the ingested stream together.

        The files stay untouched. Either part is an external table in a database of its own, called
        after what it holds, so a part is never dropped or moved and the view changes in one step; the
        stream's is read from its root, so that its commit log is honoured.
        """
        self.ensure_layers()
        parts = self.database(RAW_PARTS)
        self._ensure_database(RAW_PARTS)
        for table in tables("raw"):
            shape, names = ddl(f"raw.{table}"), []
            for part, path, options in (
                ("landed", lake.path("raw", table), ", recursiveFileLookup 'true'"),
                ("stream", lake.stream_path(table), ""),
            ):
                called = _digest(path, shape, options)
                names.append(f"`{parts}`.`{table}_{part}_{called}`")
                self._run(
                    f"CREATE TABLE IF NOT EXISTS {names[-1]} ({shape}) USING json "
                    f"OPTIONS (path {_quoted(path)}{options})"
                )
            both = " UNION ALL ".join(f"SELECT * FROM {name}" for name in names)
            self._drop_if_table(f"raw.{table}")
            self._run(f"CREATE OR REPLACE VIEW {self.name(f'raw.{table}')} AS {both}")

    def _ensure_database(self, layer: str) -> None:
        place = f" LOCATION {_quoted(f'{self.location}/{layer}.db')}" if self.location else ""
        self._run(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}`{place}")

    def _described(self, table: str) -> dict[str, str]:
        """What the catalog knows about a table: Type, Location and so on; empty if it has none."""
        if not self.spark.catalog.tableExists(self.name(table)):
            return {}
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        return {r.col_name: r.data_type for r in rows}

    def _drop_if_table(self, table: str) -> None:
        if self._described(table).get("Type") in ("EXTERNAL", "MANAGED"):
            self._run(f"DROP TABLE {self.name(table)}")

    # --- published runs -----------------------------------------------------------------------

    @property
    def log(self) -> str:
        """The log of what the published names have shown, one entry a change."""
        folder = self.location or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{folder.rstrip('/')}/{self.prefix}published"

    def _runs(self, table: str) -> str:
        """The table with every run's files of one published name, a partition a run."""
        return f"`{self.database(RUNS)}`.`{table.replace('.', '_')}`"

    def _declared(self) -> list[str]:
        if not self.spark.catalog.databaseExists(self.database(RUNS)):
            return []
        found = {r.tableName for r in self.spark.sql(f"SHOW TABLES IN `{self.database(RUNS)}`").collect()}
        every = [f"{layer}.{t}" for layer in RUN_LAYERS for t in tables(layer)]
        return [name for name in every if name.replace(".", "_") in found]

    def _selected(self, table: str, run: str) -> str:
        columns = ", ".join(f"`{c}`" for c in schema(table).names)
        return f"SELECT {columns} FROM {self._runs(table)} WHERE run = {run}"

    def _declare(self, table: str) -> None:
        """The runs' table of a name, and the name as a view of the run that the log shows last."""
        if self.spark.catalog.tableExists(self._runs(table)):
            found = self.spark.table(self._runs(table)).drop("run").schema
            if not same_shape(found, table):
                raise ValueError(f"{self._runs(table)} exists with other columns")
        else:
            self._run(
                f"CREATE TABLE {self._runs(table)} ({ddl(table)}, run STRING) USING parquet "
                f"PARTITIONED BY (run) LOCATION {_quoted(f'{self.log}_runs/{table}')}"
            )
        if self._described(table).get("Type") != "VIEW":
            if self._described(table) and not same_shape(self.spark.table(self.name(table)).schema, table):
                raise ValueError(f"{self.name(table)} exists with other columns")
            self._drop_if_table(table)
            shown = f"(SELECT substring_index(max(value), '{_BY}', -1) FROM text.`{self.log}`)"
            self._run(f"CREATE VIEW {self.name(table)} AS {self._selected(table, shown)}")

    def show_run(self, lake: Lake, names: Iterable[str], elsewhere: Mapping[str, str] | None = None) -> str:
        """Let ``names``, and all names that were published before, show the files of the lake's current run.

        Everything up to the last step adds what nobody sees yet; the last one adds a line to the log,
        and with it all names change together. Returns what the log now shows. ``elsewhere`` gives the paths of
        tables that lie outside the run.
        """
        self.ensure_layers()
        self._ensure_database(RUNS)
        pointers.ensure_folder(self.spark, self.log)
        place, moved = current(self.spark, lake), dict(elsewhere or {})
        every = sorted({*names, *self._declared()})
        paths = {name: moved.get(name) or place.path(*name.split(".")) for name in every}
        label = _digest(*sorted(paths.values())) if moved or not place.run else place.run
        for name in every:
            self._declare(name)
            self._run(
                f"ALTER TABLE {self._runs(name)} ADD IF NOT EXISTS "
                f"PARTITION (run = {_quoted(label)}) LOCATION {_quoted(paths[name])}"
            )
            self.spark.catalog.refreshTable(self._runs(name))
        shown = pointers.entries(self.spark, self.log)
        moment = pointers.later_than(shown[-1].split(_BY)[0] if shown else None)
        pointers.add_entry(self.spark, self.log, f"{moment}{_BY}{label}")
        return label

    def shown_run(self) -> str | None:
        """What the published names show now."""
        shown = pointers.entries(self.spark, self.log)
        return shown[-1].split(_BY, 1)[1] if shown else None

    def drop_runs(self, runs: Iterable[str]) -> None:
        """Take the given runs out of the published names' tables, except for the one they show."""
        for run in set(runs) - {self.shown_run()}:
            for name in self._declared():
                self._run(f"ALTER TABLE {self._runs(name)} DROP IF EXISTS PARTITION (run = {_quoted(run)})")

    def pinned(self) -> Catalog:
        """This catalog as it is now: its names go on showing the present run, whatever is published."""
        return _Pinned(self)

    def register_refined(self, lake: Lake) -> None:
        self.show_run(lake, [f"refined.{t}" for t in tables("refined")])

    def register_curated(self, lake: Lake) -> None:
        self.show_run(lake, [f"curated.{t}" for t in tables("curated")])

    def table(self, table: str) -> DataFrame:
        if table.startswith("raw."):
            # Files may have landed, or a stream may have begun, since the name was last used.
            parts = self.database(RAW_PARTS)
            for part in self.spark.sql(f"SHOW TABLES IN `{parts}`").collect():
                if part.tableName.startswith(table.removeprefix("raw.") + "_"):
                    self.spark.catalog.refreshTable(f"`{parts}`.`{part.tableName}`")
        return self.spark.sql(f"SELECT * FROM {self.name(table)}")

    def list_tables(self) -> DataFrame:
        """layer and table name of every registered table."""
        shown = [
            self.spark.sql(f"SHOW TABLES IN `{self.database(layer)}`")
            .where(~F.col("isTemporary"))
            .select(F.lit(layer).alias("layer"), F.col("tableName").alias("table_name"))
            for layer in LAYERS
        ]
        return reduce(DataFrame.union, shown).orderBy("layer", "table_name")

    def describe_tables(self) -> DataFrame:
        """Every registered table with the rows it holds and whether its columns are the right ones."""
        rows = []
        for found in self.list_tables().collect():
            full = f"{found.layer}.{found.table_name}"
            known = found.table_name in tables(found.layer)
            df = self.table(full)
            rows.append(
                df.agg(F.count("*").alias("row_count")).select(
                    F.lit(found.layer).alias("layer"),
                    F.lit(found.table_name).alias("table_name"),
                    "row_count",
                    F.lit(known and same_shape(df.schema, full)).alias("schema_ok"),
                )
            )
        empty = "layer string, table_name string, row_count bigint, schema_ok boolean"
        return reduce(DataFrame.union, rows) if rows else self.spark.createDataFrame([], empty)

    def sellers_by_risk(self) -> DataFrame:
        """The published sellers by name, riskiest first."""
        return self.spark.sql(
            f"SELECT seller_id, seller_name, risk_label, risk_score "
            f"FROM {self.name('curated.seller_risk')} ORDER BY risk_score DESC, seller_id"
        )


class _Pinned(Catalog):
    """A catalog whose refined and curated names are fixed to one run."""

    def __init__(self, catalog: Catalog):
        super().__init__(catalog.spark, catalog.prefix, catalog.location)
        self.run = catalog.shown_run()
        if self.run is None:
            raise LookupError("nothing is published yet")

    def name(self, table: str) -> str:
        """What stands for the name in a FROM clause."""
        if table.split(".")[0] not in RUN_LAYERS:
            return super().name(table)
        return f"({self._selected(table, _quoted(self.run))})"

    def pinned(self) -> Catalog:
        return self

    def show_run(self, *_: object, **__: object) -> str:
        raise TypeError("a pinned catalog is for reading")
