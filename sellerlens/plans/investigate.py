"""Analyst investigations over curated and refined tables.

Sorts end in a unique key, so the order of equal scores is the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerlens.functions import plot_colour
from sellerlens.policy import HIGH, MEDIUM, UNVERIFIED

# Days in a stretch of a seller's calendar when spikes are looked for.
SPIKE_STRETCH = 365


def _top_down(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *(tie_break or ("seller_id",)))


def high_risk(risk: DataFrame) -> DataFrame:
    """Sellers labelled HIGH."""
    return _top_down(risk.where(F.col("risk_label") == HIGH), "risk_score").drop(
        "avg_order_amount", "risk_index"
    )


def suspicious_returns(risk: DataFrame, above: float = 0.4) -> DataFrame:
    """Sellers whose return rate is above the given share, with the rate in percent."""
    return _top_down(risk.where(F.col("return_rate") > above), "return_rate").select(
        "seller_id",
        "seller_name",
        "total_orders",
        "total_returns",
        F.round(F.col("return_rate") * 100, 2).alias("return_rate_pct"),
        "risk_score",
    )


def repeated_high_severity(risk: DataFrame, at_least: int = 2) -> DataFrame:
    column = "high_severity_complaints"
    return _top_down(risk.where(F.col(column) >= at_least), column).select(
        "seller_id", "seller_name", "region", "total_complaints", column, "risk_label"
    )


def latest_fraud(fraud: DataFrame) -> DataFrame:
    return _top_down(fraud, "flagged_at")


def unverified_risky(risk: DataFrame) -> DataFrame:
    """Unverified sellers labelled HIGH or MEDIUM."""
    hits = risk.where(
        (F.col("verification_status") == UNVERIFIED) & F.col("risk_label").isin(HIGH, MEDIUM)
    )
    return _top_down(hits, "risk_score").select(
        "seller_id",
        "seller_name",
        "region",
        "verification_status",
        "risk_score",
        "risk_label",
        "total_complaints",
    )


def complaint_breakdown(complaints: DataFrame) -> DataFrame:
    """Complaints per seller and category."""
    counted = complaints.groupBy("seller_id", "category").agg(
        F.count("*").alias("complaint_count"),
        F.count_if(F.col("severity") == "high").alias("high_severity_count"),
    )
    return _top_down(counted, "complaint_count", "seller_id", "category")


def daily_volume(orders: DataFrame) -> DataFrame:
    """Orders and revenue per seller and day, busiest days first."""
    counted = orders.groupBy("seller_id", F.to_date("event_ts").alias("order_date")).agg(
        F.count("*").alias("daily_orders"),
        F.sum("amount").alias("daily_revenue"),
    )
    return _top_down(counted, "daily_orders", "seller_id", "order_date")


def daily_spikes(
    orders: DataFrame, days: int = 28, times: float = 3.0, least_orders: int = 5, least_days: int = 7
) -> DataFrame:
    """Days on which a seller sold far more than on the calendar days before.

    A day is held against the ``days`` before it, days without orders as zero, back to the seller's first
    one. Its usual volume is their median, its usual deviation the median distance from it, which a few
    earlier spikes do not move. A spike is ``least_orders`` or more, and above the median by more than ``times`` such
    deviations (one order, where days were all alike). The first ``least_days`` of a seller are not judged.

    Sellers are cut into stretches of days; each takes along the days that its first ones look
    back to, so that a seller of any age is the work of several tasks.
    """
    day = F.unix_date(F.to_date("event_ts"))
    daily = (
        orders.where(F.col("event_ts").isNotNull()).groupBy("seller_id", day.alias("day"))
        .agg(F.count("*").alias("daily_orders"))
    )
    first = daily.groupBy("seller_id").agg(F.min("day").alias("first_day"))
    stretch = F.floor(F.col("day") / SPIKE_STRETCH)
    reach = F.floor((F.col("day") + days) / SPIKE_STRETCH)
    seen_by = daily.withColumn("own", stretch).withColumn(
        "stretch", F.explode(F.sequence(stretch, reach))
    )
    before = Window.partitionBy("seller_id", "stretch").orderBy("day").rangeBetween(-days, -1)
    looked_back = (
        seen_by.withColumn("sold", F.collect_list("daily_orders").over(before))
        .where(F.col("own") == F.col("stretch")).join(first, "seller_id")
        .withColumn("baseline_days", F.least(F.lit(days), F.col("day") - F.col("first_day")))
        .where((F.col("baseline_days") >= least_days) & (F.col("daily_orders") >= least_orders))
    )
    nothing = F.array_repeat(F.lit(0).cast("long"), F.col("baseline_days") - F.size("sold"))
    judged = looked_back.withColumn("usual", _usual(F.sort_array(F.concat("sold", nothing)))).withColumns(
        {name: F.col("usual")[name] for name in ("median_orders", "median_deviation")}
    )
    above = F.col("daily_orders") - F.col("median_orders")
    spikes = judged.where(above > times * F.greatest(F.col("median_deviation"), F.lit(1.0 / times)))
    found = spikes.select(
        "seller_id", F.date_from_unix_date("day").alias("order_date"), "daily_orders", "baseline_days",
        "median_orders", "median_deviation",
    )
    # The sort looks at its input twice, once for its ranges: shuffled before, that is the spikes, not all days.
    return _top_down(found.repartition("order_date"), "daily_orders", "seller_id", "order_date")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; filters copy what stands behind a column's name to each mention."""
    return F.transform(F.array(value), use)[0]


def _usual(ordered: Column) -> Column:
    """The median of a sorted array, and the median distance from it."""

    def deviation(every: Column, middle: Column) -> Column:
        return _once(F.sort_array(F.transform(every, lambda n: F.abs(n - middle))), _middle)

    return _once(ordered, lambda every: _once(_middle(every), lambda middle: F.struct(
        middle.alias("median_orders"), deviation(every, middle).alias("median_deviation")
    )))


def _middle(ordered: Column) -> Column:
    """The median of a sorted array, null if it is empty."""
    low, high = (F.floor((F.size(ordered) + i) / 2).cast("int") - 1 for i in (1, 2))
    return (F.get(ordered, low) + F.get(ordered, high)) / F.lit(2.0)


def returns_and_complaints(
    risk: DataFrame, return_rate_above: float = 0.3, complaints_at_least: int = 2
) -> DataFrame:
    hits = risk.where(
        (F.col("return_rate") > return_rate_above)
        & (F.col("total_complaints") >= complaints_at_least)
    )
    return _top_down(hits, "risk_score").select(
        "seller_id",
        "seller_name",
        "return_rate",
        "total_complaints",
        "high_severity_complaints",
        "risk_score",
        "risk_label",
    )


def of_seller(df: DataFrame, seller_id: str | Column) -> DataFrame:
    """The rows of one seller; the filter reaches the Parquet scan."""
    return df.where(F.col("seller_id") == seller_id)


def seller_profile(
    risk: DataFrame, fraud: DataFrame, seller_id: str | None = None
) -> DataFrame:
    """A seller's risk row with its fraud pattern, if any; all sellers without an id."""
    if seller_id is not None:
        risk, fraud = of_seller(risk, seller_id), of_seller(fraud, seller_id)
    patterns = fraud.select("seller_id", "pattern_type", "explanation")
    return risk.drop("risk_index").join(patterns, "seller_id", "left")


def top_sellers(risk: DataFrame, n: int = 10) -> DataFrame:
    return (
        _top_down(risk, "risk_score")
        .limit(n)
        .select(
            "seller_id",
            "seller_name",
            "region",
            "risk_score",
            "risk_label",
            "return_rate",
            "high_severity_complaints",
        )
    )


def high_risk_brief(risk: DataFrame) -> DataFrame:
    """HIGH sellers in the seven columns of the exploration notebook."""
    return high_risk(risk).select(
        "seller_id",
        "seller_name",
        "region",
        "risk_score",
        "risk_label",
        "return_rate",
        "high_severity_complaints",
    )


def score_distribution(risk: DataFrame) -> DataFrame:
    """Series behind the score bar plot."""
    return risk.select(
        "seller_name", "risk_score", "risk_label", plot_colour("risk_label").alias("colour")
    )


def return_complaint_scatter(risk: DataFrame) -> DataFrame:
    """Series behind the return rate against complaints plot."""
    return risk.select(
        "seller_name",
        "return_rate",
        "total_complaints",
        "risk_label",
        plot_colour("risk_label").alias("colour"),
    )
