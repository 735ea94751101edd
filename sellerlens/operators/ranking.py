"""Exact row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.sources.scratch import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within partition below


def ranked(
    df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)`` for groups of any size.

    A window would sort each group in one task. Here a range sort spreads a group over
    many tasks, every row is stored with its place (partition, row in partition), and a row's
    number is its place within its partition plus the rows of its group in earlier partitions.
    The sorted rows go to a table in the shared scratch folder first: their place has
    to be the same for the counts and for the rows, also after a lost executor.
    ``order`` should be total, or ties are numbered in an arbitrary order.
    """
    placed = materialize(
        df.orderBy(*by, *order).withColumn("_at", F.monotonically_increasing_id()), "ranking"
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))

    # One row per (partition, group): a group has at most one run per sort partition, so this
    # window never sees more rows of a group than there are partitions. The runs are written
    # too: with their size known, Spark broadcasts them below its threshold and shuffles
    # beyond it, on keys no fuller than one sort partition.
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("_part", *by).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first")
    )
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1
    starts = materialize(
        runs.select(
            F.col("_part").alias("_run_part"),
            *[F.col(c).alias(f"_run_{c}") for c in by],
            shift.alias("_shift"),
        ),
        "ranking-runs",
    )
    same_run = F.col("_part") == F.col("_run_part")
    for c in by:
        same_run = same_run & F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    numbered = placed.join(starts, same_run).withColumn(name, F.col("_at") + F.col("_shift"))
    return numbered.select(name, *df.columns)
