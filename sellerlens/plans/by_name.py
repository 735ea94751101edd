"""Investigations in SQL over published names, for analysts who hold nothing but a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sellerlens.sources.catalog import Catalog


def complaint_breakdown(catalog: Catalog, at_least: int = 1) -> DataFrame:
    """Complaints per seller and category, of those with at least so many."""
    return catalog.spark.sql(
        f"""SELECT seller_id, category, count(*) AS complaint_count,
                   count_if(severity = 'high') AS high_severity_count
            FROM {catalog.name("refined.complaints")}
            GROUP BY seller_id, category HAVING count(*) >= :at_least
            ORDER BY complaint_count DESC, seller_id, category""",
        args={"at_least": at_least},
    )


def seller_profile(catalog: Catalog, seller_id: str) -> DataFrame:
    """A seller's risk row with its fraud pattern, if any."""
    return catalog.spark.sql(
        f"""SELECT r.* EXCEPT (risk_index), f.pattern_type, f.explanation
            FROM {catalog.name("curated.seller_risk")} r
            LEFT JOIN {catalog.name("curated.fraud_patterns")} f ON f.seller_id = r.seller_id
            WHERE r.seller_id = :seller""",
        args={"seller": seller_id},
    )
