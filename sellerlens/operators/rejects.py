"""What the orders normaliser drops, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import open_interval, parsed_number, parsed_timestamp
from sellerlens.operators.normalize import order_is_valid
from sellerlens.policy import DEFAULT_POLICY, RiskPolicy
from sellerlens.schemas import CORRUPT


def order_issue(df: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> Column:
    """First matching issue of a raw order, null for a clean row."""
    amount = parsed_number("amount")
    unreadable_time = F.col("timestamp").isNotNull() & parsed_timestamp("timestamp").isNull()
    issues = {
        "null_order_id": F.col("order_id").isNull(),
        "null_seller_id": F.col("seller_id").isNull(),
        "bad_amount": amount.isNull(),
        "amount_out_of_range": ~open_interval(amount, policy.amount_above, policy.amount_below),
        "bad_timestamp": unreadable_time,
    }
    if CORRUPT in df.columns:
        issues = {"corrupt_record": F.col(CORRUPT).isNotNull(), **issues}
    return F.coalesce(*[F.when(found, name) for name, found in issues.items()])


def order_issues(raw: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    """Raw orders with an issue. ``rejected`` is false for the one harmless issue: a bad
    timestamp becomes null and the row goes on.

    A corrupt record counts as rejected only when the parser could not save its key
    and amount; with those present the row passes the normaliser's rules.
    """
    flagged = raw.withColumn("issue", order_issue(raw, policy))
    return flagged.where(F.col("issue").isNotNull()).withColumn(
        "rejected", ~order_is_valid(policy)
    )


def rejected_orders(raw: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    return order_issues(raw, policy).where(F.col("rejected")).drop("rejected")
