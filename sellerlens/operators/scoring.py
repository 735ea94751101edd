"""The risk model: narrow column expressions over one row per seller."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import as_of_column, ratio
from sellerlens.policy import DEFAULT_POLICY, HIGH, LOW, MEDIUM, UNVERIFIED, RiskPolicy
from sellerlens.schemas import columns

AsOf = str | date | datetime | None

COMPONENTS = (
    "return_component",
    "complaint_volume_component",
    "complaint_severity_component",
    "trust_component",
    "new_seller_component",
)


def _unverified() -> Column:
    return F.col("verification_status") == UNVERIFIED


def _points(condition: Column, points: float) -> Column:
    """``points`` where the condition holds; false and unknown both give nothing."""
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def risk_components(
    aggregates: DataFrame, as_of: AsOf = None, policy: RiskPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Seller aggregates plus the five weighted components and the rates behind them."""
    newcomer = F.lit(0.0)
    for days, penalty in reversed(policy.new_seller_bands):
        newcomer = F.when(F.col("days_active") < days, F.lit(penalty)).otherwise(newcomer)
    rated = aggregates.withColumns(
        {
            "complaint_rate": ratio("total_complaints", "total_orders"),
            "high_severity_rate": ratio("high_severity_complaints", "total_complaints"),
            "days_active": F.date_diff(
                as_of_column(as_of).cast("date"), F.col("registration_date").cast("date")
            ),
        }
    )
    capped_rate = F.least(F.col("complaint_rate"), F.lit(policy.complaint_rate_cap))
    return rated.withColumns(
        {
            "return_component": F.col("return_rate") * policy.return_weight,
            "complaint_volume_component": capped_rate * policy.complaint_weight,
            "complaint_severity_component": F.col("high_severity_rate") * policy.severity_weight,
            "trust_component": _points(_unverified(), policy.unverified_penalty),
            "new_seller_component": newcomer,
        }
    )


def _risk_index() -> Column:
    total = F.col(COMPONENTS[0])
    for name in COMPONENTS[1:]:
        total = total + F.col(name)
    return total


def _risk_score(policy: RiskPolicy) -> Column:
    parts = [
        F.col("return_rate") * policy.score_return_weight,
        F.col("high_severity_complaints") * policy.score_high_complaint,
        _points(_unverified(), policy.score_unverified),
        _points(
            F.col("total_complaints") > policy.score_complaints_above, policy.score_many_complaints
        ),
        _points(F.col("total_orders") > policy.score_orders_above, policy.score_many_orders),
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def risk_label(index: Column, policy: RiskPolicy = DEFAULT_POLICY) -> Column:
    return (
        F.when(index >= policy.high_index, HIGH)
        .when(index >= policy.medium_index, MEDIUM)
        .otherwise(LOW)
    )


def score(
    aggregates: DataFrame, as_of: AsOf = None, policy: RiskPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Components plus risk_index, risk_score and risk_label (decided on the index)."""
    return (
        risk_components(aggregates, as_of, policy)
        .withColumns({"risk_index": _risk_index(), "risk_score": _risk_score(policy)})
        .withColumn("risk_label", risk_label(F.col("risk_index"), policy))
    )


def seller_risk(scored: DataFrame) -> DataFrame:
    """The curated projection of :func:`score`."""
    return scored.select(columns("curated.seller_risk"))
