"""Per-seller metrics of refined facts.

Facts are aggregated before any join, so partial aggregation absorbs hot sellers and
every join works on one row per seller. Refined keys are never null, so events are counted
by row: the scans leave out the id columns, the widest of each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import ratio
from sellerlens.schemas import columns

COUNTS = ("total_orders", "total_returns", "total_complaints", "high_severity_complaints")


def order_metrics(orders: DataFrame) -> DataFrame:
    """Every order counts, whatever its status."""
    return orders.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.avg("amount").alias("avg_order_amount"),
    )


def return_metrics(returns: DataFrame) -> DataFrame:
    """Returns count even if their order is unknown."""
    return returns.groupBy("seller_id").agg(F.count("*").alias("total_returns"))


def complaint_metrics(complaints: DataFrame) -> DataFrame:
    return complaints.groupBy("seller_id").agg(
        F.count("*").alias("total_complaints"),
        F.count_if(F.col("severity") == "high").alias("high_severity_complaints"),
    )


def seller_aggregates(
    sellers: DataFrame, orders: DataFrame, returns: DataFrame, complaints: DataFrame
) -> DataFrame:
    """Every seller with its activity; sellers without any keep zeros.

    return_rate is not capped and can pass 1.
    """
    return with_metrics(
        sellers, order_metrics(orders), return_metrics(returns), complaint_metrics(complaints)
    )


def with_metrics(sellers: DataFrame, *per_seller: DataFrame) -> DataFrame:
    """Sellers with metrics of theirs, wherever those were computed; none means zero."""
    joined = sellers
    for metrics in per_seller:
        joined = joined.join(metrics, "seller_id", "left")
    filled = joined.fillna(0, [*COUNTS, "avg_order_amount"])
    return filled.withColumn("return_rate", ratio("total_returns", "total_orders")).select(
        columns("refined.seller_aggregates")
    )
