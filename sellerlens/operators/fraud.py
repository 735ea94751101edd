"""Fraud flags over scored sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import as_of_column
from sellerlens.operators.scoring import AsOf
from sellerlens.policy import (
    DEFAULT_POLICY,
    EXPLANATIONS,
    HIGH_RETURN_RATE,
    REPEATED_HIGH_COMPLAINTS,
    UNVERIFIED,
    UNVERIFIED_WITH_COMPLAINTS,
    RiskPolicy,
)
from sellerlens.schemas import columns


def flagged(scored: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    """Sellers that meet at least one fraud condition."""
    returns_often = F.col("return_rate") > policy.fraud_return_rate
    complained_about = F.col("high_severity_complaints") >= policy.fraud_high_complaints
    unknown_and_noisy = (F.col("verification_status") == UNVERIFIED) & (
        F.col("total_complaints") > policy.fraud_unverified_complaints
    )
    return scored.where(returns_often | complained_about | unknown_and_noisy)


def fraud_patterns(
    scored: DataFrame, as_of: AsOf = None, policy: RiskPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One pattern per flagged seller, the first that matches.

    The last pattern is a catch-all: a verified seller flagged only for a return rate
    between the flag and the pattern thresholds gets it too.
    """
    pattern = (
        F.when(F.col("return_rate") > policy.pattern_return_rate, HIGH_RETURN_RATE)
        .when(
            F.col("high_severity_complaints") >= policy.fraud_high_complaints,
            REPEATED_HIGH_COMPLAINTS,
        )
        .otherwise(UNVERIFIED_WITH_COMPLAINTS)
    )
    explanation = F.lit(EXPLANATIONS[UNVERIFIED_WITH_COMPLAINTS])
    for name in (REPEATED_HIGH_COMPLAINTS, HIGH_RETURN_RATE):
        explanation = F.when(F.col("pattern_type") == name, EXPLANATIONS[name]).otherwise(
            explanation
        )
    return (
        flagged(scored, policy)
        .withColumn("pattern_type", pattern)
        .withColumns(
            {
                "indicator_value": F.col("risk_score"),
                "threshold": F.lit(policy.fraud_threshold),
                "flagged_at": as_of_column(as_of),
                "explanation": explanation,
            }
        )
        .select(columns("curated.fraud_patterns"))
    )
