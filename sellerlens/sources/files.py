"""File scans and sinks of the three layers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from sellerlens.schemas import CORRUPT, same_shape, schema
from sellerlens.sources import pointers

RUN_LAYERS = ("refined", "curated")
# Facts whose files are ranges of a seller; the second column splits sellers with very many rows.
LAID_OUT = {
    "refined.orders": ("seller_id", "order_id"),
    "refined.returns": ("seller_id", "return_id"),
}


def range_column(table: str) -> str:
    return LAID_OUT[table][0]



@dataclass(frozen=True)
class Lake:
    """Where the layers live. Streams land beside the landed files, not among them: a stream's
    folder has a commit log, and only a reader that starts at that folder honours it.

    With ``run``, refined and curated tables are those of one pipeline run, in a folder of its own."""

    base: str
    run: str | None = None

    @property
    def root(self) -> str:
        return self.base.rstrip("/")

    def run_path(self, run: str) -> str:
        return f"{self.root}/runs/{run}"

    def path(self, layer: str, table: str) -> str:
        if self.run and layer in RUN_LAYERS:
            return f"{self.run_path(self.run)}/{layer}/{table}"
        return f"{self.root}/{layer}/{table}"

    def index_path(self, layer: str, table: str) -> str:
        """What the files of a laid-out table hold."""
        return f"{self.run_path(self.run) if self.run else self.root}/_index/{layer}/{table}"

    def stream_path(self, table: str) -> str:
        return self.path("raw_stream", table)

    @property
    def log_path(self) -> str:
        return f"{self.root}/runs_done"


def finished_runs(spark: SparkSession, lake: Lake) -> list[str]:
    """Runs that passed their gate, oldest first."""
    return pointers.entries(spark, lake.log_path)


def current(spark: SparkSession, lake: Lake) -> Lake:
    """The lake as its last finished run left it; a lake that names a run, or has none, as it is."""
    if lake.run:
        return lake
    done = finished_runs(spark, lake)
    return replace(lake, run=done[-1]) if done else lake


def new_run(lake: Lake) -> Lake:
    """The lake with a run of its own to write to; runs sort by when they began."""
    return replace(lake, run=f"{pointers.stamp()}-{uuid.uuid4().hex[:8]}")


def finish_run(spark: SparkSession, lake: Lake) -> None:
    """Make the lake's run the current one, in one step."""
    pointers.add_entry(spark, lake.log_path, lake.run)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below ``path``, 0 where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def forget_runs(
    spark: SparkSession, lake: Lake, keep: int, grace: timedelta = timedelta(0), held: Iterable[str] = ()
) -> list[str]:
    """Delete all finished runs but the last ``keep``, and their entries; returns the deleted runs.

    Runs that began within ``grace`` stay, because somebody may still read them, and so do those of ``held``.
    """
    limit = pointers.stamp(datetime.now(UTC) - grace)
    old = [
        run for run in finished_runs(spark, lake)[:-keep] if run < limit and run not in set(held)
    ] if keep > 0 else []
    for run in old:
        pointers.remove(spark, lake.run_path(run))
        pointers.remove_entry(spark, lake.log_path, run)
    return old


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_json_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All JSON lines under ``path``, nested folders included, as raw table ``table``.

    A malformed line is kept: its columns are null and its text is in ``_corrupt_record``.
    """
    wanted = StructType([*schema(f"raw.{table}").fields]).add(CORRUPT, StringType())
    reader = spark.read.schema(wanted).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("recursiveFileLookup", "true").json(path)


def _read_stream_landing(spark: SparkSession, path: str, table: str) -> DataFrame:
    # No recursive lookup here, so Spark lists the files from the sink's commit log.
    wanted = StructType([*schema(f"raw.{table}").fields]).add(CORRUPT, StringType())
    return spark.read.schema(wanted).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_raw(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The raw table: landed files and ingested streams together."""
    parts = []
    for reader, path in (
        (read_json_lines, lake.path("raw", table)),
        (_read_stream_landing, lake.stream_path(table)),
    ):
        try:
            parts.append(reader(spark, path, table))
        except AnalysisException as error:
            if not _missing(error):
                raise
    if not parts:
        raise FileNotFoundError(f"nothing landed for raw.{table} under {lake.base}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_table(spark: SparkSession, lake: Lake, layer: str, table: str) -> DataFrame:
    return spark.read.schema(schema(f"{layer}.{table}")).parquet(lake.path(layer, table))


def write_table(
    df: DataFrame, lake: Lake, layer: str, table: str, cluster_by: tuple[str, ...] = ()
) -> str:
    """Replace one table of a layer.

    ``cluster_by`` sorts inside each output file, without a shuffle: a lookup on those
    columns then skips most row groups and pages of every file.
    """
    path = lake.path(layer, table)
    pointers.remove(df.sparkSession, lake.index_path(layer, table))
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)
    return path


def write_laid_out(
    df: DataFrame, lake: Lake, layer: str, table: str, by: tuple[str, ...], files: int | None = None
) -> str:
    """Replace one table of a layer, its files ranges of ``by``, with an index of what each holds.

    One range shuffle. A value of the first column that very many rows share goes on over as many files
    as it needs, split by the columns behind it; other values are in one file, or two. The index has one row
    a file: its name, least and greatest value of the first column, and rows. It goes before the files
    change and comes when they are complete, so there is never one that lies. ``files`` is the
    session's shuffle size by default, merged by adaptive execution where it is too many.
    """
    spark, path, index = df.sparkSession, lake.path(layer, table), lake.index_path(layer, table)
    pointers.remove(spark, index)
    ranged = df.repartitionByRange(*by) if files is None else df.repartitionByRange(files, *by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    held = read_table(spark, lake, layer, table).withColumn("file", F.col("_metadata.file_name"))
    file_spans(held, by[0]).coalesce(1).write.mode("overwrite").parquet(index)
    return path


def file_spans(held: DataFrame, column: str) -> DataFrame:
    """Least and greatest value of a text column, and rows, of each ``file``.

    Counted per value first, which needs no sort; the least of texts, found from all rows, would sort them all.
    """
    counted = held.groupBy("file", column).agg(F.count("*").alias("n"))
    return counted.groupBy("file").agg(
        F.min(column).alias("first"), F.max(column).alias("last"), F.sum("n").alias("row_count")
    )


def read_ranged(spark: SparkSession, lake: Lake, layer: str, table: str, value: str) -> DataFrame:
    """The rows of a laid-out table whose first range column is ``value``.

    Only the files that the index names are listed and opened; a table without index is filtered as a whole.
    """
    every = schema(f"{layer}.{table}")
    index = lake.index_path(layer, table)
    whole = f"{layer}.{table}"
    if not pointers.exists(spark, index):
        return read_table(spark, lake, layer, table).where(F.col(range_column(whole)) == value)
    spans = spark.read.schema("file STRING, first STRING, last STRING").parquet(index)
    names = [r.file for r in spans.where(F.lit(value).between(F.col("first"), F.col("last"))).collect()]
    if not names:
        return spark.createDataFrame([], every)
    paths = [f"{lake.path(layer, table)}/{name}" for name in sorted(names)]
    return spark.read.schema(every).parquet(*paths).where(F.col(range_column(whole)) == value)


def export_json(df: DataFrame, path: str, compression: str = "none") -> str:
    """One JSON object per row, written by the executors; null fields are spelled out."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false").option("compression", compression)
    writer.json(path)
    return path


def land_files(spark: SparkSession, source: str, target: str, compression: str = "none") -> str:
    """Copy text files line by line, unparsed, and replace what lies at ``target``."""
    lines = spark.read.option("lineSep", "\n").text(source)
    lines.write.mode("overwrite").option("lineSep", "\n").option("compression", compression).text(target)
    return target


class PublishGateError(RuntimeError):
    """The curated output is missing, empty or has the wrong shape."""


def publish_gate(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    table: str,
    must_pass: bool = True,
    rows_required: bool = True,
) -> DataFrame:
    """One row about a written table: does it exist, how many rows, is its schema right.

    Raises instead of returning a bad row unless ``must_pass`` is off. The row count comes
    from file footers.
    """
    name = f"{layer}.{table}"
    exists, rows, schema_ok = True, 0, False
    try:
        found = spark.read.parquet(lake.path(layer, table))
        rows, schema_ok = found.count(), same_shape(found.schema, name)
    except AnalysisException as error:
        if not (_missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA"):
            raise
        exists = False
    enough = rows > 0 or not rows_required
    if must_pass and not (exists and enough and schema_ok):
        raise PublishGateError(f"{name}: exists={exists}, rows={rows}, schema_ok={schema_ok}")
    return spark.range(1).select(
        F.lit(name).alias("table_name"),
        F.lit(exists).alias("table_exists"),
        F.lit(rows).cast("bigint").alias("row_count"),
        F.lit(schema_ok).alias("schema_ok"),
    )
