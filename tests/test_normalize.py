from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sellerlens.operators.dedupe import latest_per_key
from sellerlens.operators.normalize import (
    NORMALIZERS,
    normalize_complaints,
    normalize_orders,
    normalize_returns,
    normalize_sellers,
    require,
    valid_orders,
)
from sellerlens.operators.rejects import order_issues, rejected_orders
from sellerlens.schemas import RAW_TABLES, same_shape
from tests.conftest import by, dicts


def order(order_id="O1", **fields):
    base = {
        "order_id": order_id,
        "seller_id": "S1",
        "customer_id": "C1",
        "amount": "10.5",
        "timestamp": "2026-04-28T10:00:00",
        "status": "completed",
        "category": "luxury",
    }
    return {**base, **fields}


@pytest.mark.parametrize(
    ("amount", "kept"),
    [
        ("-1", False),
        ("0", False),
        ("0.01", True),
        ("9999.99", True),
        ("10000", False),
        (None, False),
        ("12", True),
        ("abc", False),
        ("NaN", False),
        ("Infinity", False),
    ],
)
def test_amount_interval(table, amount, kept):
    assert (normalize_orders(table("raw.orders", order(amount=amount))).count() == 1) is kept


def test_orders_are_typed_and_cleaned(table):
    raw = table("raw.orders", order(status="  COMPLETED ", category=" Home_Goods"))
    clean = normalize_orders(raw)
    assert same_shape(clean.schema, "refined.orders")
    assert dicts(clean) == [
        {
            "order_id": "O1",
            "seller_id": "S1",
            "customer_id": "C1",
            "amount": 10.5,
            "event_ts": datetime(2026, 4, 28, 10, 0),
            "status": "completed",
            "category": "home_goods",
        }
    ]


def test_trim_takes_spaces_only(table):
    raw = table("raw.orders", order(status="\tDone "))
    assert dicts(normalize_orders(raw))[0]["status"] == "\tdone"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-04-28T10:00:00", datetime(2026, 4, 28, 10)),
        ("2026-04-28T10:00:00.123456", datetime(2026, 4, 28, 10, 0, 0, 123456)),
        ("bad", None),
        (None, None),
    ],
)
def test_timestamps_never_reject_a_row(table, text, expected):
    assert dicts(normalize_orders(table("raw.orders", order(timestamp=text))))[0][
        "event_ts"
    ] == expected


@pytest.mark.parametrize("key", ["order_id", "seller_id"])
def test_null_keys_are_dropped(table, key):
    assert normalize_orders(table("raw.orders", order(**{key: None}))).count() == 0


def test_valid_row_survives_an_invalid_twin(table):
    raw = table(
        "raw.orders",
        order(amount="5", timestamp="2026-01-01T00:00:00"),
        order(amount="-5", timestamp="2026-02-01T00:00:00"),
    )
    assert [r["amount"] for r in dicts(normalize_orders(raw))] == [5.0]


def test_latest_row_wins_and_unknown_time_is_oldest(table):
    raw = table(
        "raw.orders",
        order(seller_id="S2", timestamp="2026-01-01T00:00:00"),
        order(seller_id="S3", timestamp="2026-03-01T00:00:00"),
        order(seller_id="S4", timestamp="bad"),
    )
    assert [r["seller_id"] for r in dicts(normalize_orders(raw))] == ["S3"]


def test_equal_times_fall_back_to_the_other_columns(table):
    raw = table("raw.orders", order(seller_id="S9"), order(seller_id="S2"), order(seller_id="S5"))
    assert [r["seller_id"] for r in dicts(normalize_orders(raw))] == ["S2"]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("ABC"), st.integers(0, 2), st.sampled_from("xyz")),
        min_size=1,
        max_size=12,
    ),
    parts=st.integers(1, 5),
    seed=st.randoms(use_true_random=False),
)
def test_dedupe_ignores_row_order_and_partitioning(spark, rows, parts, seed):
    shuffled = list(rows)
    seed.shuffle(shuffled)
    names = "k STRING, t INT, v STRING"
    expected = {}
    for k, t, v in rows:
        best = expected.get(k)
        if best is None or (-t, v) < (-best[0], best[1]):
            expected[k] = (t, v)
    got = latest_per_key(spark.createDataFrame(shuffled, names).repartition(parts), "k", "t")
    assert {r.k: (r.t, r.v) for r in got.collect()} == expected


def test_one_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("id").cast("string"))
        .alias("k"),
        F.col("id").alias("t"),
        F.lit("v").alias("v"),
    )
    got = latest_per_key(hot, "k", "t")
    assert got.count() == 2001
    assert got.where("k = 'hot'").first().t == 2997


def test_normalising_twice_changes_nothing(table):
    raw = table(
        "raw.orders", order(), order(amount="7"), order("O2", status=" PENDING "), order("O3")
    )
    once = normalize_orders(raw)
    again = normalize_orders(once.withColumn("timestamp", F.col("event_ts").cast("string")))
    assert sorted(once.collect()) == sorted(again.collect())


def test_returns(table):
    row = {
        "return_id": "R1",
        "order_id": "unknown",
        "seller_id": "S1",
        "timestamp": "2026-01-01T00:00:00",
        "reason": " Wrong_Item",
        "status": "APPROVED ",
    }
    raw = table(
        "raw.returns",
        row,
        {**row, "timestamp": "2026-01-02T00:00:00"},
        {**row, "return_id": None},
        {**row, "return_id": "R2", "seller_id": None},
    )
    clean = normalize_returns(raw)
    assert same_shape(clean.schema, "refined.returns")
    (only,) = dicts(clean)
    assert only["event_ts"] == datetime(2026, 1, 2)
    assert (only["reason"], only["status"]) == ("wrong_item", "approved")


def test_complaints_repeat_with_other_times(table):
    # Five copies per id with different times, as in the shipped complaint file.
    raw = table(
        "raw.complaints",
        *[
            {
                "complaint_id": f"CMP9910{i}",
                "seller_id": "S62",
                "timestamp": f"2026-04-2{day}T10:00:00",
                "severity": "HIGH" if day else "high ",
                "category": "counterfeit_claim",
            }
            for i in range(3)
            for day in range(5)
        ],
        {"complaint_id": "CMP1", "seller_id": "S1", "severity": None},
    )
    clean = by(normalize_complaints(raw), "complaint_id")
    assert len(clean) == 4
    assert clean["CMP99100"]["event_ts"] == datetime(2026, 4, 24, 10)
    assert clean["CMP99102"]["severity"] == "high"
    assert clean["CMP1"]["severity"] is None


def test_sellers(table):
    row = {
        "seller_id": " S1 ",
        "seller_name": " Shop ",
        "registration_date": "2025-01-10",
        "region": "Asia ",
        "category": "Luxury",
        "verification_status": " Unverified ",
        "support_tier": "GOLD",
    }
    raw = table(
        "raw.sellers",
        row,
        {**row, "registration_date": "2024-01-10"},
        {**row, "seller_id": "S2", "registration_date": "never", "verification_status": None},
        {**row, "seller_id": None},
    )
    clean = by(normalize_sellers(raw), "seller_id")
    assert set(clean) == {"S1", "S2"}
    assert clean["S1"]["registration_date"] == date(2025, 1, 10)
    assert clean["S1"]["verification_status"] == "unverified"
    assert (clean["S1"]["seller_name"], clean["S1"]["region"]) == ("Shop", "Asia")
    assert clean["S2"]["registration_date"] is None
    assert clean["S2"]["verification_status"] is None


def test_every_raw_table_has_a_normaliser_with_the_refined_schema(table):
    assert set(NORMALIZERS) == set(RAW_TABLES)
    for name, normalise in NORMALIZERS.items():
        assert same_shape(normalise(table(f"raw.{name}")).schema, f"refined.{name}")


def test_require(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a INT, b INT")
    assert require(df, "a", "b").count() == 1


def test_rejects_duplicates_and_refined_add_up_to_raw(table):
    raw = table(
        "raw.orders",
        order("O1"),
        order("O1", amount="11"),
        order("O2", amount="abc"),
        order("O3", amount="10000"),
        order(None),
        order("O4", seller_id=None),
        order("O5", timestamp="bad"),
    )
    rejected, valid = rejected_orders(raw).count(), valid_orders(raw).count()
    refined = normalize_orders(raw).count()
    assert (rejected, valid, refined) == (4, 3, 2)
    assert raw.count() == rejected + (valid - refined) + refined


def test_issue_names(table):
    raw = table(
        "raw.orders",
        order(None),
        order("a", seller_id=None),
        order("b", amount="abc"),
        order("c", amount=None),
        order("d", amount="0"),
        order("e", timestamp="bad"),
        order("f", timestamp=None),
    )
    issues = {r.order_id: (r.issue, r.rejected) for r in order_issues(raw).collect()}
    assert issues == {
        None: ("null_order_id", True),
        "a": ("null_seller_id", True),
        "b": ("bad_amount", True),
        "c": ("bad_amount", True),
        "d": ("amount_out_of_range", True),
        "e": ("bad_timestamp", False),
    }
