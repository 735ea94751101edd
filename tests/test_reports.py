from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sellerlens.operators.fraud import fraud_patterns
from sellerlens.operators.ranking import ranked
from sellerlens.operators.scoring import score, seller_risk
from sellerlens.plans import investigate, reports
from tests.conftest import AS_OF, by, dicts
from tests.test_scoring import GOLDEN, golden, sellers  # noqa: F401


@pytest.fixture
def risk(golden):  # noqa: F811
    return seller_risk(score(golden, AS_OF))


@pytest.fixture
def fraud(golden):  # noqa: F811
    return fraud_patterns(score(golden, AS_OF), AS_OF)


RANKED = ["S58", "S61", "S62", "S55", "S56", "S60", "S57", "S59"]


def test_headlines(risk):
    (row,) = dicts(reports.headline_kpis(risk))
    assert row["avg_risk_score"] == pytest.approx(237.6, abs=0.05)
    del row["avg_risk_score"]
    assert row == {
        "sellers": 8,
        "high_risk": 2,
        "medium_risk": 2,
        "low_risk": 4,
        "total_orders": 670,
    }


def test_region_cards(risk):
    cards = dicts(reports.region_cards(risk))
    expected = [
        ("Middle East", 61.8, 61.8, "MEDIUM", "BudgetFinds", 1),
        ("Asia", 37.2, 74.4, "LOW", "CheapGoods", 2),
        ("Europe", 28.1, 84.3, "LOW", "PremiumHub", 3),
        ("North America", 22.8, 45.7, "LOW", "TechZone Store", 2),
    ]
    assert [c["region"] for c in cards] == [e[0] for e in expected]
    for card, (_, mean, total, label, first, count) in zip(cards, expected):
        assert card["mean_risk_index"] == pytest.approx(mean, abs=0.07)
        assert card["total_risk_index"] == pytest.approx(total, abs=0.07)
        assert (card["region_label"], card["riskiest_seller"]) == (label, first)
        assert card["sellers"] == count


def test_region_members(risk):
    members = dicts(reports.region_members(risk).where("region = 'Europe'").orderBy("place"))
    assert [(m["place"], m["seller_name"]) for m in members] == [
        (1, "PremiumHub"),
        (2, "QuickDeals"),
        (3, "LuxuryGoods"),
    ]


def test_a_large_region_is_one_card(spark):
    many = spark.range(1000).select(
        F.lit("Europe").alias("region"),
        F.concat(F.lit("S"), "id").alias("seller_id"),
        F.concat(F.lit("n"), "id").alias("seller_name"),
        F.col("id").cast("double").alias("risk_score"),
        F.lit(50.0).alias("risk_index"),
    )
    (card,) = dicts(reports.region_cards(many))
    assert (card["sellers"], card["total_risk_index"]) == (1000, 50_000.0)
    assert (card["riskiest_seller"], card["region_label"]) == ("n999", "MEDIUM")
    assert reports.region_members(many).count() == 1000


def test_unknown_region_is_a_region(risk):
    nowhere = risk.withColumn("region", F.lit(None).cast("string"))
    (card,) = dicts(reports.region_cards(nowhere))
    assert (card["region"], card["sellers"]) == (None, 8)


def test_priority_list(risk):
    rows = dicts(reports.priority_list(risk).orderBy("priority"))
    assert [r["priority"] for r in rows] == list(range(1, 9))
    assert [r["seller_id"] for r in rows] == RANKED
    first, last = rows[0], rows[-1]
    assert (first["return_rate_pct"], first["return_rate_colour"]) == (45.5, "#ef4444")
    assert (first["verification_colour"], first["complaint_colour"]) == ("#ef4444", "#ef4444")
    assert (first["label_colour"], first["label_text_colour"]) == ("#ef4444", "#b91c1c")
    assert (last["verification_colour"], last["complaint_colour"]) == ("#22c55e", "#64748b")
    assert (last["return_rate_colour"], last["label_background"]) == ("#22c55e", "#dcfce7")
    assert rows[2]["return_rate_colour"] == "#f59e0b"
    top = dicts(reports.priority_list(risk, top=3))
    assert [r["seller_id"] for r in top] == RANKED[:3]


def test_fraud_table(fraud):
    row = by(reports.fraud_table(fraud), "seller_id")["S58"]
    assert row["score"] == 748.2
    assert row["flagged_at"] == "2026-04-28 00:00:00"


def test_series(risk):
    bars = dicts(reports.seller_score_series(risk))
    assert bars[0] == {"seller_name": "BudgetFinds", "risk_score": 748.2, "colour": "#ef4444"}
    doughnut = dicts(reports.region_index_series(risk))
    assert [d["region"] for d in doughnut] == ["Middle East", "Asia", "Europe", "North America"]
    assert [d["total_risk_index"] for d in doughnut] == pytest.approx(
        [61.8, 74.4, 84.3, 45.7], abs=0.1
    )


@pytest.mark.parametrize("partitions", [1, 7])
def test_ranking_equals_a_window_also_with_one_hot_group(spark, partitions):
    rows = spark.range(0, 900, 1, partitions).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 11))
        .alias("g"),
        (F.col("id") * 37 % 5).alias("v"),
    )
    rows.createOrReplaceTempView("to_rank")
    order = [F.col("v").desc(), F.col("id")]
    grouped = ranked(rows, order, by=["g"], name="n")
    want = spark.sql(
        "SELECT row_number() OVER (PARTITION BY g ORDER BY v DESC, id) AS n, id, g, v FROM to_rank"
    )
    assert sorted(map(str, grouped.collect())) == sorted(map(str, want.collect()))
    overall = ranked(rows, order, name="n")
    want = spark.sql("SELECT row_number() OVER (ORDER BY v DESC, id) AS n, id, g, v FROM to_rank")
    assert sorted(map(str, overall.collect())) == sorted(map(str, want.collect()))


def test_investigations(risk, fraud):
    def ids(df):
        return [r.seller_id for r in df.collect()]

    assert ids(investigate.high_risk(risk)) == ["S58", "S61"]
    assert len(investigate.high_risk(risk).columns) == 11
    assert ids(investigate.suspicious_returns(risk)) == ["S58", "S61"]
    assert investigate.suspicious_returns(risk).first().return_rate_pct == 45.54
    assert ids(investigate.repeated_high_severity(risk)) == [
        "S58", "S61", "S62", "S55", "S56", "S60", "S57",
    ]
    assert ids(investigate.latest_fraud(fraud)) == sorted(g[0] for g in GOLDEN if g[12])
    assert ids(investigate.unverified_risky(risk)) == ["S58", "S61", "S56"]
    assert ids(investigate.returns_and_complaints(risk)) == ["S58", "S61"]
    assert ids(investigate.top_sellers(risk)) == RANKED
    assert ids(investigate.top_sellers(risk, 2)) == RANKED[:2]
    assert len(investigate.high_risk_brief(risk).columns) == 7
    bars = by(investigate.score_distribution(risk), "seller_name")
    assert bars["QuickDeals"]["colour"] == "orange"
    assert investigate.return_complaint_scatter(risk).columns == [
        "seller_name", "return_rate", "total_complaints", "risk_label", "colour",
    ]


def test_profiles(risk, fraud):
    (one,) = dicts(investigate.seller_profile(risk, fraud, "S59"))
    assert len(one) == 14 and one["pattern_type"] is None
    assert investigate.seller_profile(risk, fraud, "S58").first().pattern_type
    assert investigate.seller_profile(risk, fraud).count() == 8
    # A seller id is data, never SQL text.
    assert investigate.seller_profile(risk, fraud, "x' OR '1'='1").count() == 0


def test_complaints_and_volume(table):
    complaints = table(
        "refined.complaints",
        *[
            {"complaint_id": str(i), "seller_id": s, "category": c, "severity": v}
            for i, (s, c, v) in enumerate(
                [("B", "fraud", "high"), ("A", "fraud", "low"), ("A", "fraud", "high"),
                 ("A", "poor_quality", None)]
            )
        ],
    )
    assert [tuple(r) for r in investigate.complaint_breakdown(complaints).collect()] == [
        ("A", "fraud", 2, 1),
        ("A", "poor_quality", 1, 0),
        ("B", "fraud", 1, 1),
    ]
    at = datetime(2026, 1, 1, 23, 59)
    orders = table(
        "refined.orders",
        {"order_id": "1", "seller_id": "A", "amount": 1.0, "event_ts": at},
        {"order_id": "2", "seller_id": "A", "amount": 2.0, "event_ts": at.replace(hour=0)},
        {"order_id": "3", "seller_id": "A", "amount": 4.0, "event_ts": at.replace(day=2)},
        {"order_id": "4", "seller_id": "A", "amount": 8.0},
    )
    volume = investigate.daily_volume(orders).collect()
    assert [(r.daily_orders, r.daily_revenue) for r in volume] == [(2, 3.0), (1, 8.0), (1, 4.0)]
    assert volume[1].order_date is None
