from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from sellerlens.operators.fraud import flagged, fraud_patterns
from sellerlens.operators.metrics import seller_aggregates
from sellerlens.operators.scoring import risk_components, score, seller_risk
from sellerlens.policy import EXPLANATIONS
from sellerlens.schemas import same_shape
from tests.conftest import AS_OF, by, dicts

TODAY = date(2026, 4, 28)


@pytest.fixture
def sellers(table):
    """Aggregate rows; return_rate follows from the counts unless given."""

    def build(*rows: dict):
        filled = []
        for i, row in enumerate(rows):
            base = {
                "seller_id": f"S{i}",
                "registration_date": date(2020, 1, 1),
                "verification_status": "verified",
                "total_orders": 100,
                "avg_order_amount": 10.0,
                "total_returns": 0,
                "total_complaints": 0,
                "high_severity_complaints": 0,
            }
            base.update(row)
            if "return_rate" not in base:
                orders = base["total_orders"]
                base["return_rate"] = base["total_returns"] / orders if orders else 0.0
            filled.append(base)
        return table("refined.seller_aggregates", *filled)

    return build


# seller, name, region, verification, orders, returns, complaints, high, average amount,
# score, index, label, pattern
# Fixed sample values.
GOLDEN = [
    ("S58", "BudgetFinds", "Middle East", "unverified", 101, 46, 60, 47, 329.6, 748.2, 61.8, "HIGH", "REPEATED_HIGH_COMPLAINTS"),
    ("S61", "CheapGoods", "Asia", "unverified", 66, 29, 36, 26, 403.6, 442.6, 58.1, "HIGH", "REPEATED_HIGH_COMPLAINTS"),
    ("S62", "PremiumHub", "Europe", "verified", 106, 28, 24, 22, 617.4, 345.6, 37.4, "MEDIUM", "REPEATED_HIGH_COMPLAINTS"),
    ("S55", "TechZone Store", "North America", "verified", 54, 12, 10, 6, 327.5, 113.9, 27.0, "LOW", "REPEATED_HIGH_COMPLAINTS"),
    ("S56", "QuickDeals", "Europe", "unverified", 71, 20, 24, 4, 305.2, 106.3, 33.0, "MEDIUM", "REPEATED_HIGH_COMPLAINTS"),
    ("S60", "FastShip Co", "North America", "verified", 82, 9, 8, 4, 339.6, 79.4, 18.7, "LOW", "REPEATED_HIGH_COMPLAINTS"),
    ("S57", "MegaSupplies", "Asia", "verified", 97, 9, 4, 2, 324.5, 48.7, 16.3, "LOW", "REPEATED_HIGH_COMPLAINTS"),
    ("S59", "LuxuryGoods", "Europe", "verified", 93, 2, 2, 1, 328.8, 15.9, 13.8, "LOW", None),
]


@pytest.fixture
def golden(sellers):
    return sellers(
        *[
            {
                "seller_id": g[0],
                "seller_name": g[1],
                "region": g[2],
                "verification_status": g[3],
                "total_orders": g[4],
                "total_returns": g[5],
                "total_complaints": g[6],
                "high_severity_complaints": g[7],
                "avg_order_amount": g[8],
            }
            for g in GOLDEN
        ]
    )


def test_golden_scores(golden):
    risk = seller_risk(score(golden, AS_OF))
    assert same_shape(risk.schema, "curated.seller_risk")
    found = by(risk, "seller_id")
    assert len(found) == len(GOLDEN)
    for g in GOLDEN:
        row = found[g[0]]
        assert row["risk_score"] == pytest.approx(g[9], abs=0.05)
        assert row["risk_index"] == pytest.approx(g[10], abs=0.05)
        assert row["risk_label"] == g[11]


def test_golden_fraud(golden):
    fraud = fraud_patterns(score(golden, AS_OF), AS_OF)
    assert same_shape(fraud.schema, "curated.fraud_patterns")
    found = by(fraud, "seller_id")
    assert {g[0]: g[12] for g in GOLDEN if g[12]} == {
        s: row["pattern_type"] for s, row in found.items()
    }
    assert found["S58"]["threshold"] == 30.0
    assert found["S58"]["indicator_value"] == pytest.approx(748.2, abs=0.05)
    assert found["S58"]["flagged_at"] == datetime(2026, 4, 28)
    assert found["S58"]["explanation"] == EXPLANATIONS["REPEATED_HIGH_COMPLAINTS"]


@pytest.mark.parametrize(
    ("days", "penalty"),
    [(0, 5.0), (179, 5.0), (180, 2.5), (364, 2.5), (365, 0.0), (None, 0.0)],
)
def test_new_seller_bands(sellers, days, penalty):
    registered = None if days is None else TODAY - timedelta(days=days)
    (row,) = dicts(risk_components(sellers({"registration_date": registered}), AS_OF))
    assert row["days_active"] == days
    assert row["new_seller_component"] == penalty


@pytest.mark.parametrize(
    ("status", "penalty"), [("unverified", 10.0), ("verified", 0.0), (None, 0.0)]
)
def test_trust(sellers, status, penalty):
    (row,) = dicts(score(sellers({"verification_status": status}), AS_OF))
    assert row["trust_component"] == penalty
    assert row["risk_score"] == penalty * 2


def test_rates_without_orders_or_complaints_are_zero(sellers):
    (row,) = dicts(
        score(sellers({"total_orders": 0, "total_complaints": 0, "total_returns": 3}), AS_OF)
    )
    assert (row["complaint_rate"], row["high_severity_rate"], row["risk_index"]) == (0, 0, 0)


def test_complaint_rate_is_capped_and_return_rate_is_not(sellers):
    (row,) = dicts(
        score(
            sellers({"total_complaints": 150, "total_returns": 120, "high_severity_complaints": 150,
                     "verification_status": "unverified"}),
            AS_OF,
        )
    )
    assert row["complaint_rate"] == 1.5
    assert row["complaint_volume_component"] == 35.0
    assert row["return_component"] == pytest.approx(30.0)
    assert row["risk_index"] == pytest.approx(100.0)


@pytest.mark.parametrize(
    ("rate", "label"), [(1.2, "MEDIUM"), (1.19, "LOW"), (2.2, "HIGH"), (2.19, "MEDIUM")]
)
def test_labels_start_at_30_and_55(sellers, rate, label):
    (row,) = dicts(score(sellers({"return_rate": rate}), AS_OF))
    assert row["risk_label"] == label


@pytest.mark.parametrize(
    ("complaints", "orders", "expected"),
    [(3, 100, 0.0), (4, 100, 15.0), (3, 101, -10.0), (4, 101, 5.0)],
)
def test_score_steps(sellers, complaints, orders, expected):
    (row,) = dicts(score(sellers({"total_complaints": complaints, "total_orders": orders}), AS_OF))
    assert row["risk_score"] == expected


@pytest.mark.parametrize(
    ("row", "pattern"),
    [
        ({"return_rate": 0.3}, None),
        ({"return_rate": 0.31}, "UNVERIFIED_WITH_COMPLAINTS"),  # catch-all, though verified
        ({"return_rate": 0.5}, "UNVERIFIED_WITH_COMPLAINTS"),
        ({"return_rate": 0.51}, "HIGH_RETURN_RATE"),
        ({"return_rate": 0.51, "high_severity_complaints": 5}, "HIGH_RETURN_RATE"),
        ({"high_severity_complaints": 1}, None),
        ({"high_severity_complaints": 2}, "REPEATED_HIGH_COMPLAINTS"),
        ({"verification_status": "unverified", "total_complaints": 2}, None),
        (
            {"verification_status": "unverified", "total_complaints": 3},
            "UNVERIFIED_WITH_COMPLAINTS",
        ),
        ({"total_complaints": 30}, None),
        ({"verification_status": None, "total_complaints": 30}, None),
    ],
)
def test_fraud_rules(sellers, row, pattern):
    scored = score(sellers(row), AS_OF)
    found = dicts(fraud_patterns(scored, AS_OF))
    assert [f["pattern_type"] for f in found] == ([pattern] if pattern else [])
    assert flagged(scored).count() == len(found)
    if pattern:
        assert found[0]["explanation"] == EXPLANATIONS[pattern]


def test_as_of_defaults_to_now(sellers):
    (row,) = dicts(risk_components(sellers({"registration_date": date.today()})))
    assert row["days_active"] in (0, 1)


def test_aggregates_keep_idle_sellers_and_the_sellers_own_category(table):
    sellers = table(
        "refined.sellers",
        {"seller_id": "A", "category": "luxury"},
        {"seller_id": "B", "category": "clothing"},
    )
    orders = table(
        "refined.orders",
        {"order_id": "1", "seller_id": "A", "amount": 10.0, "status": "cancelled"},
        {"order_id": "2", "seller_id": "A", "amount": 20.0, "category": "electronics"},
        {"order_id": "3", "seller_id": "ghost", "amount": 20.0},
    )
    returns = table(
        "refined.returns",
        *[{"return_id": str(i), "order_id": "unknown", "seller_id": "A"} for i in range(3)],
    )
    complaints = table(
        "refined.complaints",
        {"complaint_id": "1", "seller_id": "A", "severity": "high", "category": "fraud"},
        {"complaint_id": "2", "seller_id": "A", "severity": None},
    )
    rows = by(seller_aggregates(sellers, orders, returns, complaints), "seller_id")
    assert set(rows) == {"A", "B"}
    a, b = rows["A"], rows["B"]
    assert (a["total_orders"], a["avg_order_amount"], a["total_returns"]) == (2, 15.0, 3)
    assert (a["total_complaints"], a["high_severity_complaints"]) == (2, 1)
    assert (a["return_rate"], a["category"]) == (1.5, "luxury")
    assert b["avg_order_amount"] == 0.0 and b["return_rate"] == 0.0
    assert b["total_orders"] == b["total_returns"] == b["total_complaints"] == 0
    assert b["seller_name"] is None
