"""Quality checks over refined tables, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality(df: DataFrame, table: str, key: str, invalid: Column) -> DataFrame:
    """One row: total, invalid and duplicate rows, and PASSED when both of the latter are 0.

    Grouping by key first gives the duplicates without a distinct pass; rows without a key
    form one group, so all but one of them count as duplicates. Map-side
    aggregation collapses a hot key before the shuffle.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("copies"), F.count_if(invalid).alias("invalid")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        "total_rows",
        "invalid_rows",
        "duplicate_rows",
        F.when((F.col("invalid_rows") == 0) & (F.col("duplicate_rows") == 0), "PASSED")
        .otherwise("FAILED")
        .alias("status"),
    )


def quality_orders(orders: DataFrame) -> DataFrame:
    missing = F.col("order_id").isNull() | F.col("seller_id").isNull()
    return quality(orders, "refined.orders", "order_id", missing | (F.col("amount") <= 0))


def quality_returns(returns: DataFrame) -> DataFrame:
    missing = F.col("return_id").isNull() | F.col("seller_id").isNull()
    return quality(returns, "refined.returns", "return_id", missing)


def quality_complaints(complaints: DataFrame) -> DataFrame:
    missing = F.col("complaint_id").isNull() | F.col("seller_id").isNull()
    return quality(complaints, "refined.complaints", "complaint_id", missing)


# Base-2 logarithm of a sketch's registers: 16,384 of them, about 16 kB a run and table.
SKETCH_LG = 14
# Four standard errors of an estimate from merged sketches.
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH_LG / 2)


def key_sketch(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row to keep from a run: its rows, those without a key, and a sketch of its different keys.

    Sketches of several runs merge into that of all their rows, so that duplicates across runs are
    estimated without reading any run again.
    """
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(key).isNull()).alias("null_rows"),
        F.hll_sketch_agg(key, SKETCH_LG).alias("sketch"),
    ).select(F.lit(table).alias("table_name"), "total_rows", "null_rows", "sketch")


def merged_duplicates(sketches: DataFrame) -> DataFrame:
    """Rows and estimated duplicates per table over the runs that ``sketches`` has a row of.

    ``error_bound`` is how far the estimate may be off (four standard errors). Rows without a key count as copies of one another,
    as in ``quality``.
    """
    merged = sketches.groupBy("table_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_rows").alias("null_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"),
    )
    different = F.col("keys") + F.when(F.col("null_rows") > 0, 1).otherwise(0)
    return merged.select(
        "table_name", "total_rows", F.greatest(F.col("total_rows") - different, F.lit(0)).alias("duplicate_estimate"),
        F.ceil(F.col("keys") * SKETCH_ERROR).alias("error_bound"),
    )
