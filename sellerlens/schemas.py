"""Table schemas by ``layer.table`` name.

Schemas are always explicit: inference costs a second pass over the raw layer
and makes column types depend on the data.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"

# raw.orders.amount is text: an explicit DOUBLE turns a quoted number into a
# corrupt record, while text keeps both 12 and "12" for the cast in refined.
# Names and types of every table's columns.
_DDL = {
    "raw.orders": """order_id STRING, seller_id STRING, customer_id STRING, amount STRING,
        timestamp STRING, status STRING, category STRING""",
    "raw.returns": """return_id STRING, order_id STRING, seller_id STRING, timestamp STRING,
        reason STRING, status STRING""",
    "raw.complaints": """complaint_id STRING, seller_id STRING, timestamp STRING,
        severity STRING, category STRING""",
    "raw.sellers": """seller_id STRING, seller_name STRING, registration_date STRING,
        region STRING, category STRING, verification_status STRING, support_tier STRING""",
    "refined.orders": """order_id STRING, seller_id STRING, customer_id STRING, amount DOUBLE,
        event_ts TIMESTAMP, status STRING, category STRING""",
    "refined.returns": """return_id STRING, order_id STRING, seller_id STRING, event_ts TIMESTAMP,
        reason STRING, status STRING""",
    "refined.complaints": """complaint_id STRING, seller_id STRING, event_ts TIMESTAMP,
        severity STRING, category STRING""",
    "refined.sellers": """seller_id STRING, seller_name STRING, registration_date DATE,
        region STRING, category STRING, verification_status STRING, support_tier STRING""",
    "refined.seller_aggregates": """seller_id STRING, seller_name STRING, registration_date DATE,
        region STRING, category STRING, verification_status STRING, support_tier STRING,
        total_orders BIGINT, avg_order_amount DOUBLE, total_returns BIGINT, total_complaints BIGINT,
        high_severity_complaints BIGINT, return_rate DOUBLE""",
    "curated.seller_risk": """seller_id STRING, seller_name STRING, region STRING,
        verification_status STRING, total_orders BIGINT, total_returns BIGINT, return_rate DOUBLE,
        total_complaints BIGINT, high_severity_complaints BIGINT, avg_order_amount DOUBLE,
        risk_score DOUBLE, risk_index DOUBLE, risk_label STRING""",
    "curated.fraud_patterns": """seller_id STRING, pattern_type STRING, indicator_value DOUBLE,
        threshold DOUBLE, flagged_at TIMESTAMP, explanation STRING""",
}

LAYERS = ("raw", "refined", "curated")
RAW_TABLES = ("orders", "returns", "complaints", "sellers")


def ddl(table: str) -> str:
    return " ".join(_DDL[table].split())


def schema(table: str) -> StructType:
    return StructType.fromDDL(ddl(table))


def columns(table: str) -> list[str]:
    return schema(table).names


def tables(layer: str) -> list[str]:
    """Table names of one layer, without the layer prefix."""
    return [name.split(".")[1] for name in _DDL if name.startswith(layer + ".")]


def same_shape(found: StructType, table: str) -> bool:
    """Same column names and types in the same order; nullability is free."""
    wanted = schema(table)
    return [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in wanted]
