from __future__ import annotations

import hashlib
import random
from datetime import date, datetime, timedelta
from statistics import median

import pytest

from sellerlens.operators.quality import quality_complaints, quality_orders, quality_returns
from sellerlens.operators.roles import (
    ACCESS,
    BUSINESS,
    DENIED,
    TRUST_SAFETY,
    access_level,
    access_matrix,
    mask_customers,
    role_view,
)
from sellerlens.plans import investigate
from sellerlens.plans.activity import (
    customer_activity,
    event_counts,
    layer_counts,
    orders_with_returns,
)
from sellerlens.plans.governance import access_report, quality_report
from tests.conftest import by, dicts


def digest(text: str, length: int = 64) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:length]


@pytest.fixture
def orders(table):
    return table(
        "refined.orders",
        {"order_id": "1", "seller_id": "A", "customer_id": "C1", "amount": 10.0},
        {"order_id": "2", "seller_id": "A", "customer_id": "C1", "amount": 20.0},
        {"order_id": "3", "seller_id": "A", "customer_id": "C2", "amount": 5.0},
        {"order_id": "4", "seller_id": "A", "customer_id": None, "amount": 7.0},
        {"order_id": "5", "seller_id": "B", "customer_id": "C1", "amount": 9.0},
    )


@pytest.fixture
def returns(table):
    return table(
        "refined.returns",
        {"return_id": "1", "order_id": "1", "seller_id": "A"},
        {"return_id": "2", "order_id": "1", "seller_id": "A"},  # same order, counts once
        {"return_id": "3", "order_id": "3", "seller_id": "B"},  # other seller, no match
        {"return_id": "4", "order_id": "4", "seller_id": "A"},
        {"return_id": "5", "order_id": "99", "seller_id": "A"},  # unknown order
        {"return_id": "6", "order_id": None, "seller_id": "A"},
    )


def test_customer_activity_of_a_seller(orders, returns):
    rows = by(customer_activity(orders, returns, "A"), "customer")
    assert rows[digest("C1", 8)] == {
        "seller_id": "A",
        "customer": digest("C1", 8),
        "customer_id_masked": digest("C1"),
        "total_orders": 2,
        "total_amount": 30.0,
        "total_returns": 1,
    }
    assert rows[digest("C2", 8)]["total_returns"] == 0
    assert (rows[None]["total_orders"], rows[None]["total_returns"]) == (1, 0)


def test_customer_activity_of_all_sellers(orders, returns):
    rows = dicts(customer_activity(orders, returns))
    assert sorted((r["seller_id"], r["total_orders"]) for r in rows) == [
        ("A", 1), ("A", 1), ("A", 2), ("B", 1),
    ]
    salted = dicts(customer_activity(orders, returns, "B", salt="pepper"))
    assert salted[0]["customer"] == digest("pepperC1", 8)


def test_customers_of_one_prefix_can_be_told_apart(table, returns):
    seen, pair = {}, None
    for i in range(1_000_000):
        other = seen.setdefault(digest(f"C{i}", 8), i)
        if other != i:
            pair = (f"C{other}", f"C{i}")
            break
    orders = table(
        "refined.orders",
        *[{"order_id": c, "seller_id": "A", "customer_id": c, "amount": 1.0} for c in pair],
    )
    rows = dicts(customer_activity(orders, returns, "A"))
    assert len({r["customer"] for r in rows}) == 1
    assert {r["customer_id_masked"] for r in rows} == {digest(c) for c in pair}


def test_orders_with_returns(orders, returns):
    back = orders_with_returns(orders, returns)
    assert back.columns == orders.columns
    assert sorted(r.order_id for r in back.collect()) == ["1", "4"]


def test_layer_counts(table, orders):
    raw = table(
        "raw.orders",
        {"order_id": "1", "seller_id": "A", "amount": "1"},
        {"order_id": "1", "seller_id": "A", "amount": "2"},
        {"order_id": "2", "seller_id": "A", "amount": "abc"},
        {},
    )
    refined = table("refined.orders", {"order_id": "1", "seller_id": "A", "amount": 1.0})
    (row,) = dicts(layer_counts(raw, refined, None))
    assert row == {
        "raw": 4,
        "refined": 1,
        "curated": 0,
        "duplicates_removed": 3,
        "rejected": 2,
        "true_duplicates": 1,
    }
    with pytest.raises(ValueError):
        layer_counts(None, None, None)


def test_event_counts(table, orders, returns):
    (row,) = dicts(event_counts(orders, returns, table("refined.complaints")))
    assert row == {"total": 11, "orders": 5, "returns": 6, "complaints": 0}


def test_quality(table, orders, returns):
    (clean,) = dicts(quality_orders(orders))
    assert clean == {
        "table_name": "refined.orders",
        "total_rows": 5,
        "invalid_rows": 0,
        "duplicate_rows": 0,
        "status": "PASSED",
    }
    bad = table(
        "refined.orders",
        {"order_id": "1", "seller_id": "A", "amount": 0.0},
        {"order_id": "1", "seller_id": None, "amount": 1.0},
        {"order_id": None, "seller_id": "A", "amount": 1.0},
        {"order_id": None, "seller_id": "A", "amount": 1.0},
        {"order_id": "2", "seller_id": "A", "amount": None},
    )
    (row,) = dicts(quality_orders(bad))
    assert (row["total_rows"], row["invalid_rows"], row["duplicate_rows"]) == (5, 4, 2)
    assert row["status"] == "FAILED"
    empty = table("refined.complaints")
    (row,) = dicts(quality_complaints(empty))
    assert (row["total_rows"], row["status"]) == (0, "PASSED")
    assert dicts(quality_returns(returns))[0]["invalid_rows"] == 0
    assert quality_report(orders, returns, empty).count() == 3


def test_masking_leaves_no_customer_id(orders):
    masked = mask_customers(orders)
    assert "customer_id" not in masked.columns and masked.columns[-1] == "customer_id_masked"
    values = {r.order_id: r.customer_id_masked for r in masked.collect()}
    assert values["1"] == digest("C1") and values["4"] is None
    salted = mask_customers(orders, salt="pepper").where("order_id = '1'").first()
    assert salted.customer_id_masked == digest("pepperC1")


def test_roles(table, orders):
    risk = table("curated.seller_risk", {"seller_id": "A", "risk_label": "LOW"})
    assert role_view(TRUST_SAFETY, "curated.seller_risk", risk).columns == risk.columns
    assert "customer_id" not in role_view(TRUST_SAFETY, "refined.orders", orders).columns
    assert role_view(BUSINESS, "curated.seller_risk", risk).columns == [
        "seller_id", "seller_name", "region", "risk_label",
    ]


@pytest.mark.parametrize(
    ("role", "name"),
    [
        (TRUST_SAFETY, "raw.orders"),
        (TRUST_SAFETY, "refined.returns"),
        (TRUST_SAFETY, "refined.sellers"),
        (BUSINESS, "curated.fraud_patterns"),
        (BUSINESS, "refined.orders"),
        (BUSINESS, "refined.complaints"),
        (BUSINESS, "raw.sellers"),
        ("intern", "curated.seller_risk"),
    ],
)
def test_denied(orders, role, name):
    assert access_level(role, name) == DENIED
    with pytest.raises(PermissionError):
        role_view(role, name, orders)


def test_access_reports(spark, orders, returns):
    assert access_matrix(spark).count() == len(ACCESS)
    rows = {
        (r.role, r.table_name): (r.access, r.visible_rows)
        for r in access_report({"refined.orders": orders, "refined.returns": returns}).collect()
    }
    assert rows == {
        (TRUST_SAFETY, "refined.orders"): ("masked", 5),
        (TRUST_SAFETY, "refined.returns"): ("none", 0),
        (BUSINESS, "refined.orders"): ("none", 0),
        (BUSINESS, "refined.returns"): ("none", 0),
    }
    assert access_report({"refined.returns": returns}).where("visible_rows > 0").count() == 0


def test_spikes_by_definition(table):
    rng = random.Random(7)
    rows, start = [], date(2024, 11, 1)
    for seller, usual, days in (("quiet", 0.3, 90), ("busy", 6, 120), ("old", 0.05, 1_500), ("new", 4, 6)):
        for d in range(days):
            count = sum(rng.random() < usual / 10 for _ in range(10)) + (rng.randint(6, 30) if rng.random() < 0.03 else 0)
            rows += [(seller, start + timedelta(d))] * count
    orders = [
        {"order_id": str(i), "seller_id": s, "event_ts": datetime(d.year, d.month, d.day, 5)} for i, (s, d) in enumerate(rows)
    ]
    orders.append({"order_id": "x", "seller_id": "busy", "event_ts": None})
    sold, want = {}, {}
    for s, d in rows:
        sold[s, d] = sold.get((s, d), 0) + 1
    for (s, d), n in sold.items():
        first = min(day for seller, day in sold if seller == s)
        before = [sold.get((s, d - timedelta(i)), 0) for i in range(1, 29) if d - timedelta(i) >= first]
        if len(before) < 7 or n < 5:
            continue
        usual = median(before)
        away = median(abs(x - usual) for x in before)
        if n - usual > max(3 * away, 1):
            want[s, d] = (n, len(before), usual, away)
    found = investigate.daily_spikes(table("refined.orders", *orders)).collect()
    got = {
        (r.seller_id, r.order_date): (r.daily_orders, r.baseline_days, r.median_orders, r.median_deviation) for r in found
    }
    assert got == want and len(want) > 20 and not any(s == "new" for s, _ in want)
