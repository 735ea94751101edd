"""Key de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, recency: str, dealt_by: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``key``: the latest by ``recency``, ties broken on every other column.

    The order covers all columns, so the survivor depends on neither partitioning nor
    row order. ``row_number() = 1`` lets Catalyst put a WindowGroupLimit in front of the
    shuffle: each map task keeps one row per key, so a key that holds a third of
    the input still sends at most one row per map task to its reducer.

    ``dealt_by`` names columns that the key determines; rows that are partitioned by them stay where they are.
    """
    others = [F.col(c).asc_nulls_first() for c in df.columns if c not in (key, recency, *dealt_by)]
    newest_first = Window.partitionBy(*dealt_by, key).orderBy(F.col(recency).desc_nulls_last(), *others)
    return (
        df.withColumn("_nth", F.row_number().over(newest_first))
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )
