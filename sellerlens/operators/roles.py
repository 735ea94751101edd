"""Masking and role-limited projections.

A projection is not a security boundary in open-source Spark: whoever can read the files
can read every column. Pair the views with storage permissions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sellerlens.functions import masked

TRUST_SAFETY = "trust_safety_analyst"
BUSINESS = "business_analyst"

FULL, MASKED, LIMITED, DENIED = "full", "masked", "limited", "none"

# Who may see what.
ACCESS = (
    (TRUST_SAFETY, "curated.seller_risk", FULL),
    (TRUST_SAFETY, "curated.fraud_patterns", FULL),
    (TRUST_SAFETY, "refined.complaints", FULL),
    (TRUST_SAFETY, "refined.orders", MASKED),
    (TRUST_SAFETY, "raw.*", DENIED),
    (BUSINESS, "curated.seller_risk", LIMITED),
    (BUSINESS, "curated.fraud_patterns", DENIED),
    (BUSINESS, "refined.*", DENIED),
    (BUSINESS, "raw.*", DENIED),
)
BUSINESS_COLUMNS = ("seller_id", "seller_name", "region", "risk_label")


def mask_customers(df: DataFrame, salt: str | None = None) -> DataFrame:
    """customer_id replaced by customer_id_masked, the last column."""
    return df.withColumn("customer_id_masked", masked("customer_id", salt)).drop("customer_id")


def business_view(seller_risk: DataFrame) -> DataFrame:
    return seller_risk.select(*BUSINESS_COLUMNS)


_VIEWS: dict[str, Callable[[DataFrame, str | None], DataFrame]] = {
    FULL: lambda df, _salt: df,
    MASKED: mask_customers,
    LIMITED: lambda df, _salt: business_view(df),
}


def access_level(role: str, table: str) -> str:
    """The level for ``layer.table``; whatever is not granted is denied."""
    layer = table.split(".")[0]
    for known_role, pattern, level in ACCESS:
        if known_role == role and pattern in (table, f"{layer}.*"):
            return level
    return DENIED


def role_view(role: str, table: str, df: DataFrame, salt: str | None = None) -> DataFrame:
    """What ``role`` sees of ``df``, the content of ``layer.table``; ids masked with ``salt``."""
    level = access_level(role, table)
    if level == DENIED:
        raise PermissionError(f"{role} has no access to {table}")
    return _VIEWS[level](df, salt)


def access_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ACCESS), "role STRING, table_name STRING, access STRING")
