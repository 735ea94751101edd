"""Raw to refined: typed, cleaned, validated and one row per key.

Rows are validated before they are de-duplicated. Every predicate then reads scan
columns only and runs before the shuffle, null keys never meet in one reducer, and a
key with at least one valid row is never lost to an invalid twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import (
    cleaned,
    open_interval,
    parsed_date,
    parsed_number,
    parsed_timestamp,
    trimmed,
)
from sellerlens.operators.dedupe import latest_per_key
from sellerlens.policy import DEFAULT_POLICY, RiskPolicy
from sellerlens.schemas import columns


def require(df: DataFrame, *names: str) -> DataFrame:
    """Keep rows in which every named column is present."""
    for name in names:
        df = df.where(F.col(name).isNotNull())
    return df


def _refined(raw: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    return raw.select(*[rules.get(c, F.col(c)).alias(c) for c in columns(table)])


def typed_orders(raw: DataFrame) -> DataFrame:
    """Refined column types and spellings, nothing rejected yet."""
    return _refined(
        raw,
        "refined.orders",
        {
            "amount": parsed_number("amount"),
            "event_ts": parsed_timestamp("timestamp"),
            "status": cleaned("status"),
            "category": cleaned("category"),
        },
    )


def order_is_valid(policy: RiskPolicy = DEFAULT_POLICY) -> Column:
    """Both keys present and the amount inside the open interval; never null.

    A missing or unreadable amount is invalid; an unreadable timestamp is not.
    """
    amount_ok = open_interval(parsed_number("amount"), policy.amount_above, policy.amount_below)
    keys_ok = F.col("order_id").isNotNull() & F.col("seller_id").isNotNull()
    return keys_ok & F.coalesce(amount_ok, F.lit(False))


def valid_orders(raw: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    return typed_orders(raw).where(order_is_valid(policy))


def normalize_orders(raw: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    return latest_per_key(valid_orders(raw, policy), "order_id", "event_ts")


def normalize_returns(raw: DataFrame) -> DataFrame:
    typed = _refined(
        raw,
        "refined.returns",
        {
            "event_ts": parsed_timestamp("timestamp"),
            "reason": cleaned("reason"),
            "status": cleaned("status"),
        },
    )
    return latest_per_key(require(typed, "return_id", "seller_id"), "return_id", "event_ts")


def normalize_complaints(raw: DataFrame) -> DataFrame:
    typed = _refined(
        raw,
        "refined.complaints",
        {
            "event_ts": parsed_timestamp("timestamp"),
            "severity": cleaned("severity"),
            "category": cleaned("category"),
        },
    )
    return latest_per_key(require(typed, "complaint_id", "seller_id"), "complaint_id", "event_ts")


def normalize_sellers(raw: DataFrame) -> DataFrame:
    """Profiles carry no event time; among repeated ids the newest registration wins."""
    typed = _refined(
        raw,
        "refined.sellers",
        {
            "seller_id": trimmed("seller_id"),
            "seller_name": trimmed("seller_name"),
            "registration_date": parsed_date("registration_date"),
            "region": trimmed("region"),
            "category": cleaned("category"),
            "verification_status": cleaned("verification_status"),
            "support_tier": cleaned("support_tier"),
        },
    )
    return latest_per_key(require(typed, "seller_id"), "seller_id", "registration_date")


NORMALIZERS = {
    "orders": normalize_orders,
    "returns": normalize_returns,
    "complaints": normalize_complaints,
    "sellers": normalize_sellers,
}
