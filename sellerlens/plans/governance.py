"""Reports on data quality and on who sees what."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.operators.quality import quality_complaints, quality_orders, quality_returns
from sellerlens.operators.roles import BUSINESS, DENIED, TRUST_SAFETY, access_level, role_view
from sellerlens.plans.activity import count_of


def quality_report(orders: DataFrame, returns: DataFrame, complaints: DataFrame) -> DataFrame:
    checks = [quality_orders(orders), quality_returns(returns), quality_complaints(complaints)]
    return reduce(DataFrame.unionByName, checks)


def access_report(tables: dict[str, DataFrame]) -> DataFrame:
    """For each role and each given table: access level, visible columns and visible rows.

    Tables nobody may see are not read.
    """
    spark = next(iter(tables.values())).sparkSession
    grants, granted = [], {}
    for role in (TRUST_SAFETY, BUSINESS):
        for name, df in tables.items():
            level = access_level(role, name)
            visible = []
            if level != DENIED:
                visible, granted[name] = role_view(role, name, df).columns, df
            grants.append((role, name, level, ",".join(visible)))
    matrix = spark.createDataFrame(
        grants, "role STRING, table_name STRING, access STRING, visible_columns STRING"
    )
    if not granted:
        return matrix.withColumn("visible_rows", F.lit(0).cast("bigint"))
    counted = reduce(
        DataFrame.unionByName,
        [count_of(df, name) for name, df in granted.items()],
    ).withColumnRenamed("label", "table_name")
    rows = F.when(F.col("access") == DENIED, F.lit(0)).otherwise(F.col("n"))
    return matrix.join(counted, "table_name", "left").select(
        "role", "table_name", "access", "visible_columns", rows.alias("visible_rows")
    )
