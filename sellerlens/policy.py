"""The risk model's numbers and names, in one frozen object.

Fixed values: weights, thresholds, labels, pattern names and explanation texts
have to equal the published model for results to be comparable.
"""

from __future__ import annotations

from dataclasses import dataclass

UNVERIFIED = "unverified"
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"


@dataclass(frozen=True)
class RiskPolicy:
    # Orders outside this open interval are rejected on the way into refined.
    amount_above: float = 0.0
    amount_below: float = 10000.0

    # Components of the 0-100 index.
    return_weight: float = 25.0
    complaint_weight: float = 35.0
    complaint_rate_cap: float = 1.0
    severity_weight: float = 25.0
    unverified_penalty: float = 10.0
    # (younger than this many days, penalty), youngest first.
    new_seller_bands: tuple[tuple[int, float], ...] = ((180, 5.0), (365, 2.5))

    # Labels, decided on the index.
    high_index: float = 55.0
    medium_index: float = 30.0

    # The unbounded raw score.
    score_return_weight: float = 40.0
    score_high_complaint: float = 15.0
    score_unverified: float = 20.0
    score_complaints_above: int = 3
    score_many_complaints: float = 15.0
    score_orders_above: int = 100
    score_many_orders: float = -10.0

    # Who is flagged, and why.
    fraud_return_rate: float = 0.3
    fraud_high_complaints: int = 2
    fraud_unverified_complaints: int = 2
    pattern_return_rate: float = 0.5
    fraud_threshold: float = 30.0

    # Bands of a region's mean index.
    region_high: float = 70.0
    region_medium: float = 40.0


DEFAULT_POLICY = RiskPolicy()

HIGH_RETURN_RATE = "HIGH_RETURN_RATE"
REPEATED_HIGH_COMPLAINTS = "REPEATED_HIGH_COMPLAINTS"
UNVERIFIED_WITH_COMPLAINTS = "UNVERIFIED_WITH_COMPLAINTS"

EXPLANATIONS = {
    HIGH_RETURN_RATE: "Return rate exceeds 50% threshold",
    REPEATED_HIGH_COMPLAINTS: "Multiple high severity complaints detected",
    UNVERIFIED_WITH_COMPLAINTS: "Unverified seller with multiple complaints",
}
