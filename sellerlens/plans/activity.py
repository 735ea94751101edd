"""Customer drill-down and volume counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import masked, masked_prefix
from sellerlens.operators.normalize import order_is_valid
from sellerlens.plans.investigate import of_seller
from sellerlens.policy import DEFAULT_POLICY, RiskPolicy

_ORDER_KEY = ["seller_id", "order_id"]


def _returned_keys(returns: DataFrame) -> DataFrame:
    # Distinct before any join: an order with very many returns counts once and is
    # collapsed before the shuffle.
    return returns.select(*_ORDER_KEY).distinct()


def orders_with_returns(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Orders that came back at least once to the seller who sold them."""
    return orders.join(_returned_keys(returns), _ORDER_KEY, "left_semi").select(orders.columns)


def customer_activity(
    orders: DataFrame, returns: DataFrame, seller_id: str | None = None, salt: str | None = None
) -> DataFrame:
    """Orders, amount and returned orders of each customer of a seller (of every seller
    without an id), customers known by their masked id and shown by its first 8 hex digits.

    ``customer`` is for display: two customers may share it, ``customer_id_masked`` they do not. Orders are read once: each is marked as returned or not and one
    aggregation counts both. Orders without a customer form one row and count no returns.
    """
    if seller_id is not None:
        orders, returns = of_seller(orders, seller_id), of_seller(returns, seller_id)
    marks = _returned_keys(returns).withColumn("_returned", F.lit(True))
    per_customer = (
        orders.join(marks, _ORDER_KEY, "left")
        .groupBy("seller_id", "customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount"),
            F.count_if(F.col("_returned") & F.col("customer_id").isNotNull()).alias(
                "total_returns"
            ),
        )
    )
    return per_customer.select(
        "seller_id",
        masked_prefix("customer_id", salt=salt).alias("customer"),
        masked("customer_id", salt).alias("customer_id_masked"),
        "total_orders",
        "total_amount",
        "total_returns",
    )


def count_of(df: DataFrame, label: str) -> DataFrame:
    """One row: the label and the number of rows."""
    return df.agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n")


def layer_counts(
    raw_orders: DataFrame | None,
    refined_orders: DataFrame | None,
    seller_risk: DataFrame | None,
    policy: RiskPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Rows per layer in one row; a layer that is not there (None) counts 0.

    ``duplicates_removed`` is everything lost between raw and refined; ``rejected`` and
    ``true_duplicates`` split it.
    """
    columns = ("raw", "valid", "refined", "curated")

    def counted(df: DataFrame, **counts: Column) -> DataFrame:
        known = df.agg(*[c.alias(name) for name, c in counts.items()])
        return known.select(
            *[F.col(c) if c in counts else F.lit(0).cast("bigint").alias(c) for c in columns]
        )

    every_row = F.count("*")
    parts = []
    if raw_orders is not None:
        parts.append(counted(raw_orders, raw=every_row, valid=F.count_if(order_is_valid(policy))))
    if refined_orders is not None:
        parts.append(counted(refined_orders, refined=every_row))
    if seller_risk is not None:
        parts.append(counted(seller_risk, curated=every_row))
    if not parts:
        raise ValueError("no layer given")
    return (
        reduce(DataFrame.unionByName, parts)
        .agg(*[F.sum(c).alias(c) for c in columns])
        .select(
            "raw",
            "refined",
            "curated",
            (F.col("raw") - F.col("refined")).alias("duplicates_removed"),
            (F.col("raw") - F.col("valid")).alias("rejected"),
            (F.col("valid") - F.col("refined")).alias("true_duplicates"),
        )
    )


def event_counts(orders: DataFrame, returns: DataFrame, complaints: DataFrame) -> DataFrame:
    """All events and events per type, in one row."""
    parts = [
        count_of(orders, "orders"),
        count_of(returns, "returns"),
        count_of(complaints, "complaints"),
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.sum("n").alias("total"),
        *[
            F.sum(F.when(F.col("label") == kind, F.col("n")).otherwise(0)).alias(kind)
            for kind in ("orders", "returns", "complaints")
        ],
    )
