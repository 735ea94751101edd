"""Order, return, complaint and seller tables derived from star-schema Parquet tables.

A test-data adapter: it gives the raw layer's columns, spelled as untidily as real events
(padded and upper-case enums, text timestamps, amounts out of range, repeated order ids).
Every source row is used; per-seller variety comes from how rows are assigned to
sellers, not from dropping some.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.sources.files import folder_bytes

AS_OF = "2002-01-01 00:00:00"

# The enumerations of the domain.
REASONS = ("damaged_item", "wrong_item", "not_as_described", "changed_mind", "counterfeit")
CATEGORIES = ("electronics", "clothing", "home_goods", "luxury")
COMPLAINT_CATEGORY = {
    "error": "fraud",
    "click": "poor_quality",
    "view": "late_delivery",
    "signup": "wrong_item",
    "purchase": "counterfeit_claim",
}


# The tables that raw ones are derived from.
SOURCES = ("lineitem", "orders", "part", "events", "supplier", "nation", "region")


def source_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the files that raw tables are derived from."""
    return sum(folder_bytes(spark, f"{sf_dir.rstrip('/')}/{table}.parquet") for table in SOURCES)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _id(prefix: str, c: Column | str) -> Column:
    key = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), key.cast("string"))


def _iso(c: str, fraction: bool = False) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss" + (".SSSSSS" if fraction else ""))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def _line_key() -> Column:
    return F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per line item, with the number k that faults are dealt by."""
    order_status = (
        F.when(F.col("o_orderstatus") == "F", " Completed ")
        .when(F.col("o_orderstatus") == "P", "PENDING")
        .otherwise(" cancelled")
    )
    lines = _read(spark, sf_dir, "lineitem")
    parts = _read(spark, sf_dir, "part")
    # Lines of one order meet last, so that most repeats of an id go before the next shuffle; and they are hashed, not
    # sorted: of many lines a sort spills, while the heads of a partition are few and narrow.
    heads = _read(spark, sf_dir, "orders").hint("shuffle_hash")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .join(heads, lines.l_orderkey == heads.o_orderkey)
        .select(
            _id("O", _line_key()).alias("order_id"),
            _id("S", "l_suppkey").alias("seller_id"),
            _id("C", "o_custkey").alias("customer_id"),
            (F.col("l_extendedprice") / 10).alias("amount"),
            _iso("l_shipdate").alias("timestamp"),
            order_status.alias("status"),
            F.upper("p_type").alias("category"),
            (F.col("l_orderkey") + F.col("l_linenumber")).alias("k"),
        )
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per line item; (order, line) numbers repeat, so ids do too."""
    return _order_lines(spark, sf_dir).drop("k")


def untidy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as a careless sender gives them: amounts as padded or unreadable text, null
    keys and amounts, unreadable times, and lines that are no JSON at all."""
    every = lambda n: F.col("k") % n == 0
    broken = every(71)
    amount = F.col("amount").cast("string")
    faulty = {
        "order_id": F.when(~broken & ~every(97), F.col("order_id")),
        "seller_id": F.when(~broken & ~every(89), F.col("seller_id")),
        "customer_id": F.when(~broken, F.col("customer_id")),
        "amount": F.when(~broken & ~every(79), F.when(every(83), "n/a").when(
            every(7), F.concat(F.lit("  "), amount, F.lit(" "))).otherwise(amount)),
        "timestamp": F.when(~broken, F.when(every(73), "yesterday").otherwise(F.col("timestamp"))),
        "status": F.when(~broken, F.col("status")),
        "category": F.when(~broken, F.col("category")),
    }
    corrupt = F.when(broken, F.concat(F.lit("{"), F.col("order_id")))
    return _order_lines(spark, sf_dir).select(
        *[c.alias(name) for name, c in faulty.items()], corrupt.alias("_corrupt_record")
    )


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One return per line flagged R. Open lines of two sellers in four are booked on a
    neighbour, which spreads the return rates and leaves returns of unknown orders."""
    group = F.col("l_suppkey") % 4
    rebooked = (F.col("l_linestatus") == "O") & group.isin(2, 3)
    seller = F.col("l_suppkey") - F.when(rebooked, group).otherwise(0)
    return (
        _read(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            _id("R", _line_key()).alias("return_id"),
            _id("O", _line_key()).alias("order_id"),
            _id("S", seller).alias("seller_id"),
            _iso("l_shipdate").alias("timestamp"),
            F.upper(_pick(REASONS, F.col("l_linenumber"))).alias("reason"),
            F.lit(" Approved").alias("status"),
        )
    )


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complaint per event; every other user complains mostly about a neighbour."""
    sellers = _read(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    group = F.col("user_id") % 2
    rebooked = (group == 1) & (F.col("event_id") % 50 != 0)
    target = F.col("user_id") - F.when(rebooked, group).otherwise(0)
    high_from = F.when(F.col("user_id") % 5 == 0, 15.0).otherwise(70.0)
    severity = (
        F.when(F.col("value") >= high_from, "HIGH")
        .when(F.col("value") >= 10.0, "Medium")
        .otherwise("low")
    )
    category = F.lit(None).cast("string")
    for event_type, name in COMPLAINT_CATEGORY.items():
        category = F.when(F.col("event_type") == event_type, name).otherwise(category)
    return _read(spark, sf_dir, "events").select(
        _id("CMP", "event_id").alias("complaint_id"),
        _id("S", target % sellers).alias("seller_id"),
        _iso("ts", fraction=True).alias("timestamp"),
        severity.alias("severity"),
        category.alias("category"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _read(spark, sf_dir, "supplier")
    nations = _read(spark, sf_dir, "nation")
    regions = _read(spark, sf_dir, "region")
    registered = F.date_sub(
        F.lit("2001-12-31").cast("date"), (F.col("s_suppkey") * 37 % 2000).cast("int")
    )
    balance = F.col("s_acctbal")
    unverified = (F.col("s_suppkey") % 5 == 0) | (balance < 1000)
    tier = (
        F.when(balance < 1000, "basic")
        .when(balance < 4000, "silver")
        .when(balance < 8000, "gold")
        .otherwise("platinum")
    )
    return (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            _id("S", "s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_name"),
            registered.cast("string").alias("registration_date"),
            F.col("r_name").alias("region"),
            _pick(CATEGORIES, F.col("s_suppkey")).alias("category"),
            F.when(unverified, " Unverified ").otherwise("verified").alias("verification_status"),
            tier.alias("support_tier"),
        )
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders": raw_orders,
    "returns": raw_returns,
    "complaints": raw_complaints,
    "sellers": raw_sellers,
}
