"""Dashboard tables as DataFrames: the numbers, names and colours, not the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import (
    complaint_colour,
    label_background,
    label_colour,
    label_text_colour,
    return_rate_colour,
    verification_colour,
)
from sellerlens.operators.ranking import ranked
from sellerlens.policy import DEFAULT_POLICY, HIGH, LOW, MEDIUM, RiskPolicy


def _riskiest_first() -> list[Column]:
    return [F.col("risk_score").desc(), F.col("seller_id")]


def headline_kpis(risk: DataFrame) -> DataFrame:
    """Seller count, sellers per label, mean score and all orders, in one pass."""
    return risk.agg(
        F.count("*").alias("sellers"),
        *[
            F.count_if(F.col("risk_label") == label).alias(f"{label.lower()}_risk")
            for label in (HIGH, MEDIUM, LOW)
        ],
        F.avg("risk_score").alias("avg_risk_score"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
    )


def region_cards(risk: DataFrame, policy: RiskPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row per region, highest mean index first: its sellers, index, band and riskiest seller."""
    mean = F.col("total_risk_index") / F.col("sellers")
    first = F.struct((-F.col("risk_score")).alias("order"), "seller_id", "seller_name")
    cards = risk.groupBy("region").agg(
        F.count("*").alias("sellers"),
        F.sum("risk_index").alias("total_risk_index"),
        F.min(first)["seller_name"].alias("riskiest_seller"),
    )
    label = (
        F.when(mean >= policy.region_high, HIGH)
        .when(mean >= policy.region_medium, MEDIUM)
        .otherwise(LOW)
    )
    return cards.select(
        "region",
        "sellers",
        "riskiest_seller",
        "total_risk_index",
        mean.alias("mean_risk_index"),
        label.alias("region_label"),
        label_colour(label).alias("region_colour"),
    ).orderBy(F.col("mean_risk_index").desc(), "region")


def region_members(risk: DataFrame) -> DataFrame:
    """The sellers of each region's card, numbered from the riskiest; a row a seller.

    Unordered; ``ranked`` sorts and writes the sellers while the DataFrame is being built.
    """
    named = risk.select("region", "seller_id", "seller_name", "risk_score")
    placed = ranked(named, _riskiest_first(), by=["region"], name="place")
    return placed.select("region", "place", "seller_id", "seller_name")


def priority_list(risk: DataFrame, top: int | None = None) -> DataFrame:
    """Sellers numbered by risk; all of them unless ``top`` asks for fewer.

    The whole list comes unordered: it has been sorted once for its numbers, by ``ranked``, which
    writes the sellers while the DataFrame is being built. With ``top`` the few rows are in order.
    """
    listed = risk if top is None else risk.orderBy(*_riskiest_first()).limit(top)
    numbered = ranked(listed, _riskiest_first(), name="priority")
    percent = F.col("return_rate") * 100
    listed = numbered.select(
        "priority",
        "seller_id",
        "seller_name",
        "region",
        "verification_status",
        verification_colour("verification_status").alias("verification_colour"),
        "total_orders",
        F.round(percent, 1).alias("return_rate_pct"),
        return_rate_colour(percent).alias("return_rate_colour"),
        "high_severity_complaints",
        complaint_colour("high_severity_complaints").alias("complaint_colour"),
        F.round("risk_score", 1).alias("risk_score"),
        "risk_label",
        label_colour("risk_label").alias("label_colour"),
        label_background("risk_label").alias("label_background"),
        label_text_colour("risk_label").alias("label_text_colour"),
    )
    return listed if top is None else listed.orderBy("priority")


def fraud_table(fraud: DataFrame) -> DataFrame:
    """Fraud patterns with the score to one decimal and the time to the second."""
    return fraud.select(
        "seller_id",
        "pattern_type",
        "explanation",
        F.round("indicator_value", 1).alias("score"),
        F.date_format("flagged_at", "yyyy-MM-dd HH:mm:ss").alias("flagged_at"),
    )


def seller_score_series(risk: DataFrame) -> DataFrame:
    """Bar chart: score per seller, riskiest first."""
    return risk.orderBy(*_riskiest_first()).select(
        "seller_name",
        F.round("risk_score", 1).alias("risk_score"),
        label_colour("risk_label").alias("colour"),
    )


def region_index_series(risk: DataFrame) -> DataFrame:
    """Doughnut chart: summed index per region, in the order of each region's riskiest seller."""
    return (
        risk.groupBy("region")
        .agg(F.sum("risk_index").alias("total"), F.max("risk_score").alias("_top"))
        .orderBy(F.col("_top").desc(), "region")
        .select("region", F.round("total", 1).alias("total_risk_index"))
    )
