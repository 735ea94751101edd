"""Events as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerlens.functions.columns import parsed_number
from sellerlens.schemas import columns

# What an event carries when its sender left the field out.
DEFAULTS: dict[str, dict[str, object]] = {
    "orders": {"amount": 0.0, "status": "completed", "category": "electronics"},
    "returns": {"reason": "damaged_item", "status": "approved"},
    "complaints": {"severity": "medium", "category": "poor_quality"},
}


def encode_events(df: DataFrame, kind: str, key: str | None = None) -> DataFrame:
    """One JSON message per event in column ``value``, missing fields filled with defaults.

    ``key`` names a column to send along as the message key, for a keyed topic. Works on
    batch and streaming input, and the result fits ``format("kafka")`` and text sinks.
    An amount that is no number is sent as the text it is, for the rejects to report.
    """
    defaults = DEFAULTS[kind]

    def encoded(amount: Column) -> Column:
        fields = []
        for name in columns(f"raw.{kind}"):
            field = amount if name == "amount" else F.col(name)
            if name in defaults and field is not amount:
                field = F.coalesce(field, F.lit(defaults[name]))
            fields.append(field.alias(name))
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    message = encoded(F.lit(None))
    if "amount" in defaults:
        number = parsed_number("amount")
        unreadable = F.col("amount").isNotNull() & number.isNull()
        message = F.when(unreadable, encoded(F.col("amount").cast("string"))).otherwise(
            encoded(F.coalesce(number, F.lit(defaults["amount"])))
        )
    message = message.alias("value")
    return df.select(message) if key is None else df.select(F.col(key).alias("key"), message)


def send_events(messages: DataFrame, servers: str, topic: str) -> None:
    """Write encoded events to a topic; needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
