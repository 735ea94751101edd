"""Refined facts and their metrics kept up to date, batch by batch, without refining all history again.

A history holds one fact table's survivors in buckets of the key's hash. A batch of raw rows is cleaned as
ever, and what is left of it meets only the earlier rows with the same keys. Where a new row wins over an earlier
one, the bucket is written anew; where keys are new, rows are added beside the bucket's files; all other
files stay as they are. What was added and what it replaced, with signs, also brings the
per-seller metrics up to date.

Each batch makes a version: files, the list of files that count, metrics. Its last step adds the version to
a log, so a reader sees all of it or nothing, and a batch that failed, or came twice, can be given again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sellerlens.operators.dedupe import latest_per_key
from sellerlens.operators.metrics import with_metrics
from sellerlens.operators.normalize import NORMALIZERS
from sellerlens.schemas import CORRUPT, schema
from sellerlens.session import shuffles_freed
from sellerlens.sources import pointers
from sellerlens.sources.scratch import passing_tables

# A bucket with files of so many versions is written anew when it is next added to.
MOST_VERSIONS = 8
# A bucket is written by up to so many tasks.
BUCKET_SHARES = 8
# Between the moment and the batch in a version's name.
_BY = "="

# Doubles cannot be added and taken away again exactly; amounts with up to six places can as decimals.
_SUM_TYPES = {"amounts": "DECIMAL(38,6)"}


@dataclass(frozen=True)
class Fact:
    """A fact table's key, the sums per seller that its metrics are made of, and the metrics, in SQL."""

    key: str
    sums: dict[str, str]
    metrics: dict[str, str]


FACTS = {
    "orders": Fact(
        "order_id", {"total_orders": "1L", "amounts": "CAST(amount AS DECIMAL(28,6))"},
        {"total_orders": "total_orders", "avg_order_amount": "CAST(amounts AS DOUBLE) / total_orders"},
    ),
    "returns": Fact("return_id", {"total_returns": "1L"}, {"total_returns": "total_returns"}),
    "complaints": Fact(
        "complaint_id",
        {"total_complaints": "1L", "high_severity_complaints": "IF(severity = 'high', 1L, 0L)"},
        {"total_complaints": "total_complaints", "high_severity_complaints": "high_severity_complaints"},
    ),
}


def _per_bucket(rows: DataFrame) -> dict[int, int]:
    return {r.bucket: r.n for r in rows.groupBy("bucket").agg(F.count("*").alias("n")).collect()}


class FactHistory:
    """The survivors of one fact table under ``root``.

    ``buckets`` is fixed when a history begins: about the number of files of a few hundred MB that it will have.
    """

    def __init__(self, spark: SparkSession, root: str, table: str, buckets: int = 64):
        self.spark, self.root, self.table, self.buckets = spark, root.rstrip("/"), table, buckets
        self.fact = FACTS[table]
        self.schema = schema(f"refined.{table}")

    # --- versions -------------------------------------------------------------------------------

    @property
    def log(self) -> str:
        return f"{self.root}/versions"

    def versions(self) -> list[str]:
        return pointers.entries(self.spark, self.log)

    def batches(self) -> list[str]:
        """The batches that are part of the history."""
        return [v.split(_BY, 1)[1] for v in self.versions()]

    def files(self) -> dict[int, list[str]]:
        """For each bucket the versions whose files count: a bounded list, as long as there are buckets."""
        done = self.versions()
        if not done:
            return {}
        rows = self.spark.read.schema("bucket INT, version STRING").parquet(f"{self.root}/lists/{done[-1]}").collect()
        held: dict[int, list[str]] = {}
        for row in sorted(rows, key=lambda r: (r.bucket, r.version)):
            held.setdefault(row.bucket, []).append(row.version)
        return held

    def _of(self, held: dict[int, list[str]]) -> DataFrame:
        paths = [f"{self.root}/files/{v}/bucket={b}" for b, vs in held.items() for v in vs]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The refined table."""
        return self._of(self.files())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.fact.key), F.lit(self.buckets)).cast("int")

    def _rows(self, held: dict[int, list[str]]) -> DataFrame:
        return self._of(held).withColumn("bucket", self._bucket())

    # --- a batch --------------------------------------------------------------------------------

    def absorb(self, raw: DataFrame, batch: str) -> None:
        """Make the raw rows part of the history; a batch of the same name is taken once.

        What a batch writes on its way, tables and shuffles, is deleted as soon as it is not read any more.
        """
        if batch in self.batches():
            return
        done = self.versions()
        version = f"{pointers.later_than(done[-1].split(_BY)[0] if done else None)}{_BY}{batch}"
        with (
            shuffles_freed(self.spark), shuffles_freed(raw.sparkSession),
            passing_tables(self.spark) as written,
        ):
            self._add_version(raw, version, written)
        pointers.add_entry(self.spark, self.log, version)

    def _add_version(self, raw: DataFrame, version: str, written: Callable[[DataFrame, str], DataFrame]) -> None:
        key, held = self.fact.key, self.files()
        clean = NORMALIZERS[self.table](raw).withColumn("bucket", self._bucket())
        if held:
            added, anew = self._contested(clean, held, version, written)
        else:
            # Where nothing is held the batch is new as it is.
            added, anew = written(clean, "history-added"), set()
            self._sums(added.withColumn("_sign", F.lit(1))).write.parquet(f"{self.root}/sums/{version}")

        grown = {r.bucket for r in added.select("bucket").distinct().collect()}
        anew |= {b for b in grown if len(held.get(b, ())) >= MOST_VERSIONS}
        # A bucket is the work of several tasks and may have several files a version; small ones are merged.
        share, dealt = F.pmod(F.hash(key), F.lit(BUCKET_SHARES)), ("bucket", "_share")
        out = added.withColumn("_share", share).repartition(*dealt)
        if anew:
            # Rows of a bucket that is written anew go to the task of their share together, and there the added ones win again.
            kept = self._rows({b: vs for b, vs in held.items() if b in anew})
            both = added.withColumn("_new", F.lit(True)).unionByName(kept.withColumn("_new", F.lit(False)))
            out = latest_per_key(both.withColumn("_share", share).repartition(*dealt), key, "event_ts", dealt)
        out = out.select(added.columns).sortWithinPartitions("bucket", key)
        out.write.partitionBy("bucket").parquet(f"{self.root}/files/{version}")

        rows = [(b, v) for b, vs in held.items() if b not in anew for v in vs] + [(b, version) for b in anew | grown]
        lists = self.spark.createDataFrame(rows, "bucket int, version string").coalesce(1)
        lists.write.parquet(f"{self.root}/lists/{version}")

    def _contested(
        self, clean: DataFrame, held: dict[int, list[str]], version: str, written: Callable[[DataFrame, str], DataFrame]
    ) -> tuple[DataFrame, set[int]]:
        """The rows of a clean batch that win, and the buckets in which one of them replaces an earlier row."""
        key = self.fact.key
        with passing_tables(self.spark) as briefly:
            clean = briefly(clean, "history-batch")
            touched = {r.bucket for r in clean.select("bucket").distinct().collect()}
            earlier = self._rows({b: vs for b, vs in held.items() if b in touched})

            # Only earlier rows whose key came again are compared. Of equal rows the earlier one stays.
            again = briefly(earlier.join(clean.select(key), key, "left_semi").select(clean.columns), "history-again")
            contest = clean.withColumn("_new", F.lit(True)).unionByName(again.withColumn("_new", F.lit(False)))
            won = written(latest_per_key(contest, key, "event_ts"), "history-won")
            # Earlier rows that won come and go.
            changes = won.drop("_new").withColumn("_sign", F.lit(1)).unionByName(again.withColumn("_sign", F.lit(-1)))
            self._sums(changes).write.parquet(f"{self.root}/sums/{version}")
            stayed = _per_bucket(won.filter(~F.col("_new")))
            anew = {b for b, n in _per_bucket(again).items() if n > stayed.get(b, 0)}
        return won.filter("_new").drop("_new"), anew

    def _sums(self, changes: DataFrame) -> DataFrame:
        """Sums per seller after the changes: those before, plus what came, less what went."""
        signed = changes.select(
            "seller_id", *[(F.expr(c) * F.col("_sign")).alias(n) for n, c in self.fact.sums.items()]
        )
        total = signed.unionByName(self._state()).groupBy("seller_id").agg(
            *[F.sum(n).cast(_SUM_TYPES.get(n, "BIGINT")).alias(n) for n in self.fact.sums]
        )
        # A seller whose last row went to somebody else is gone.
        return total.filter(F.col(next(iter(self.fact.sums))) != 0)

    def _state(self) -> DataFrame:
        shape = ", ".join(["seller_id STRING", *(f"{n} {_SUM_TYPES.get(n, 'BIGINT')}" for n in self.fact.sums)])
        done = self.versions()
        if not done:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(f"{self.root}/sums/{done[-1]}")

    def metrics(self) -> DataFrame:
        """The table's metrics per seller, without reading it."""
        return self._state().select("seller_id", *[F.expr(c).alias(n) for n, c in self.fact.metrics.items()])

    # --- a stream -------------------------------------------------------------------------------

    def follow(self, rows: DataFrame, checkpoint: str, name: str = "stream") -> StreamingQuery:
        """Absorb what has arrived in a stream of raw rows since the last run, and stop.

        A micro-batch that is repeated after a failure has the name it had, so it counts once.
        """
        def take(df: DataFrame, epoch: int) -> None:
            self.absorb(df, f"{name}-{epoch}")

        return (
            rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def raw_stream(spark: SparkSession, path: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines that land in a folder, as a stream of raw rows; a malformed line has nulls only."""
    reader = spark.readStream.schema(schema(f"raw.{table}").add(CORRUPT, "string"))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).drop(CORRUPT)


def current_aggregates(sellers: DataFrame, open_history: Callable[[str], FactHistory]) -> DataFrame:
    """Sellers with the metrics of three histories: what the full run computes from all facts."""
    return with_metrics(sellers, *[open_history(table).metrics() for table in FACTS])
