"""Every operator as a query over a scale-factor folder.

Cleaning, metric and scoring operators run on the whole chain from the source tables;
investigations and reports read the layer tables it writes. Sums and means of doubles
are rounded, because their last bits depend on the order of addition: to four places, and
mean amounts to two, since a mean of three-decimal amounts often lies exactly between two
neighbours of the fourth place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.checks.marts import LANDED_AS, Marts, marts
from sellerlens.operators import fraud, metrics, normalize, quality, rejects, rekey, roles, scoring
from sellerlens.plans import activity, by_name, governance, history, investigate, pipeline, reports
from sellerlens.schemas import RAW_TABLES
from sellerlens.session import shuffles_freed
from sellerlens.sources.catalog import Catalog
from sellerlens.sources.files import (
    Lake,
    export_json,
    land_files,
    publish_gate,
    read_json_lines,
    read_raw,
    read_table,
    write_table,
)
from sellerlens.sources.scratch import materialize, passing_tables, scratch_path
from sellerlens.sources.starschema import AS_OF, untidy_orders
from sellerlens.streaming.encode import encode_events
from sellerlens.streaming.ingest import file_topic, ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# The seller of the point look-ups; every scale factor has it.
SELLER = "S5"

# Names and secrets of two keys for masked ids, for comparable output only.
MASK_KEYS = (("2001", "a secret that is no secret"), ("2002", "another one, " + "longer than a block of the hash " * 2))

_registry: dict[str, Callable[[Marts], DataFrame]] = {}


def query(fn: Callable[[Marts], DataFrame]) -> Callable[[Marts], DataFrame]:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return {
        name: (lambda spark, sf_dir, _fn=fn: _fn(marts(spark, sf_dir)))
        for name, fn in _registry.items()
    }


def rounded(df: DataFrame, *names: str) -> DataFrame:
    places = {"avg_order_amount": 2}
    return df.withColumns({name: F.round(name, places.get(name, 4)) for name in names})


def _risk(m: Marts) -> DataFrame:
    return m.table("curated.seller_risk")


def _fraud(m: Marts) -> DataFrame:
    return m.table("curated.fraud_patterns")


# --- sources and sinks -------------------------------------------------------------------


def _typed_amount(raw: DataFrame) -> DataFrame:
    return raw.withColumn("amount", F.col("amount").cast("double")).drop("_corrupt_record")


@query
def scan_raw_json(m: Marts) -> DataFrame:
    return _typed_amount(read_json_lines(m.spark, m.landed("orders").path("raw", "orders"), "orders"))


@query
def parquet_roundtrip(m: Marts) -> DataFrame:
    lake = Lake(scratch_path(m.spark, "roundtrip"))
    write_table(normalize.normalize_returns(m.raw("returns")), lake, "refined", "returns")
    return read_table(m.spark, lake, "refined", "returns")


@query
def raw_tables_by_name(m: Marts) -> DataFrame:
    catalog = m.catalog("r")
    catalog.register_raw(m.landed())
    counts = [activity.count_of(catalog.table(f"raw.{t}"), f"raw.{t}") for t in RAW_TABLES]
    return reduce(DataFrame.unionByName, counts).withColumnsRenamed(
        {"label": "table_name", "n": "row_count"}
    )


@query
def raw_orders_by_name(m: Marts) -> DataFrame:
    """Some orders land as files, the rest comes by stream; the name holds both, once each."""
    raw, lake = materialize(m.raw("orders"), "raw-orders"), Lake(scratch_path(m.spark, "both"))
    streamed = F.pmod(F.crc32("order_id"), F.lit(3)) == 0
    export_json(raw.filter(~streamed), lake.path("raw", "orders"), LANDED_AS)
    topic, offsets = scratch_path(m.spark, "topic"), scratch_path(m.spark, "offsets")
    encode_events(raw.filter(streamed), "orders").write.text(topic, compression=LANDED_AS)
    catalog = m.catalog("b")
    catalog.register_raw(lake)
    for _ in range(2):  # a restart adds nothing
        messages = file_topic(m.spark, topic, max_files_per_trigger=8)
        ingest_stream(messages, lake.stream_path("orders"), offsets, LANDED_AS).awaitTermination()
    return catalog.table("raw.orders").withColumn("amount", F.col("amount").cast("double"))


@query
def tables_by_name(m: Marts) -> DataFrame:
    for name in pipeline.PUBLISHED:
        m.table(name)
    catalog = m.catalog("t")
    catalog.register_refined(m.run.lake)
    catalog.register_curated(m.run.lake)
    return pipeline.published_counts(catalog)


@query
def publish_tables(m: Marts) -> DataFrame:
    return pipeline.published_counts(m.published())


@query
def catalog_listing(m: Marts) -> DataFrame:
    return m.published().describe_tables()


@query
def sellers_by_name(m: Marts) -> DataFrame:
    return m.published().sellers_by_risk()


@query
def land_files_query(m: Marts) -> DataFrame:
    target = scratch_path(m.spark, "landed")
    land_files(m.spark, m.landed("complaints").path("raw", "complaints"), target)
    return read_json_lines(m.spark, target, "complaints").drop("_corrupt_record")


_registry["land_files"] = _registry.pop("land_files_query")


def _ingested(m: Marts, kind: str) -> DataFrame:
    topic = scratch_path(m.spark, "topic")
    lake = Lake(scratch_path(m.spark, "ingest"))
    encode_events(m.raw(kind), kind).write.text(topic, compression=LANDED_AS)
    ingest_stream(
        file_topic(m.spark, topic, max_files_per_trigger=8),
        lake.stream_path(kind),
        scratch_path(m.spark, "offsets"),
        LANDED_AS,
    ).awaitTermination()
    return read_raw(m.spark, lake, kind).drop("_corrupt_record")


@query
def ingest_orders(m: Marts) -> DataFrame:
    return _typed_amount(_ingested(m, "orders"))


@query
def ingest_returns(m: Marts) -> DataFrame:
    return _ingested(m, "returns")


@query
def encode_events_query(m: Marts) -> DataFrame:
    return encode_events(m.raw("complaints"), "complaints", key="seller_id")


_registry["encode_events"] = _registry.pop("encode_events_query")


@query
def encode_order_events(m: Marts) -> DataFrame:
    """Orders whose status and amount were left out, so the defaults show, or are no number."""
    amount = F.col("amount").cast("string")
    sparse = m.raw("orders").withColumns(
        {
            "status": F.nullif(F.trim("status"), F.lit("PENDING")),
            "amount": F.when(F.col("amount") >= 9000, F.concat(amount, F.lit(" EUR"))).when(
                F.col("amount") >= 1000, amount
            ),
        }
    )
    return encode_events(sparse, "orders")


@query
def export_json_roundtrip(m: Marts) -> DataFrame:
    risk = _risk(m)
    path = export_json(risk, scratch_path(m.spark, "export"))
    return rounded(m.spark.read.schema(risk.schema).json(path), "avg_order_amount")


@query
def publish_gate_query(m: Marts) -> DataFrame:
    _risk(m)
    return publish_gate(m.spark, m.run.lake, "curated", "seller_risk")


_registry["publish_gate"] = _registry.pop("publish_gate_query")


# --- raw to refined -----------------------------------------------------------------------


@query
def normalize_orders(m: Marts) -> DataFrame:
    return normalize.normalize_orders(m.raw("orders"))


@query
def normalize_returns(m: Marts) -> DataFrame:
    return normalize.normalize_returns(m.raw("returns"))


@query
def normalize_complaints(m: Marts) -> DataFrame:
    return normalize.normalize_complaints(m.raw("complaints"))


@query
def normalize_sellers(m: Marts) -> DataFrame:
    return normalize.normalize_sellers(m.raw("sellers"))


@query
def dedupe_orders(m: Marts) -> DataFrame:
    """De-duplication alone: typed orders, nothing rejected."""
    typed = normalize.typed_orders(m.raw("orders"))
    return normalize.latest_per_key(typed, "order_id", "event_ts")


@query
def rejected_orders(m: Marts) -> DataFrame:
    return rejects.rejected_orders(m.raw("orders"))


@query
def untidy_order_issues(m: Marts) -> DataFrame:
    """Every reason there is, on orders with faults of every kind."""
    return rejects.order_issues(untidy_orders(m.spark, m.sf_dir))


@query
def normalize_untidy_orders(m: Marts) -> DataFrame:
    return normalize.normalize_orders(untidy_orders(m.spark, m.sf_dir))


# --- kept up to date ----------------------------------------------------------------------


def _corrected_orders(m: Marts) -> DataFrame:
    """Raw orders and, for some, a later row that halves the amount and may name another seller.

    Both rows come from one pass, so that the orders are put together once.
    """
    return _with_corrections(m.raw("orders"))


def _with_corrections(raw: DataFrame) -> DataFrame:
    later = {
        "timestamp": F.concat(F.lit("2"), F.substring("timestamp", 2, 100)),
        "amount": F.col("amount") / 2,
        "seller_id": F.when(F.col("order_id").endswith("5"), "S1").otherwise(F.col("seller_id")),
    }
    sent = F.struct(*raw.columns)
    corrected = F.struct(*[later.get(c, F.col(c)).alias(c) for c in raw.columns])
    again = F.col("order_id").endswith("3") | F.col("order_id").endswith("5")
    rows = F.when(again, F.array(sent, corrected)).otherwise(F.array(sent))
    return raw.select(F.explode(rows).alias("row")).select("row.*")


def _history(m: Marts, table: str, raw: DataFrame, batches: int = 3) -> history.FactHistory:
    """Raw rows absorbed in several batches; rows of one key are in any of them, and one batch comes twice."""
    kept = history.FactHistory(m.spark, scratch_path(m.spark, f"history-{table}"), table, buckets=16)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in raw.columns if c != "_corrupt_record"]), F.lit(batches))
    # Written once: each batch would put all raw rows together again.
    arrived = materialize(raw.withColumn("_batch", part), f"arrived-{table}")
    for i in [*range(batches), 0]:
        kept.absorb(arrived.filter(F.col("_batch") == i).drop("_batch"), f"batch-{i}")
    return kept


@query
def incremental_orders(m: Marts) -> DataFrame:
    return _history(m, "orders", _corrected_orders(m)).read()


@query
def incremental_untidy_orders(m: Marts) -> DataFrame:
    return _history(m, "orders", untidy_orders(m.spark, m.sf_dir), 4).read()


@query
def incremental_aggregates(m: Marts) -> DataFrame:
    sellers = m.table("refined.sellers")
    raw = {"orders": _corrected_orders(m), "returns": m.raw("returns"), "complaints": m.raw("complaints")}
    kept: dict[str, history.FactHistory] = {}
    pipeline.side_by_side(m.spark, lambda t: kept.update({t: _history(m, t, raw[t])}), raw)
    joined = history.current_aggregates(sellers, kept.__getitem__)
    return rounded(joined, "avg_order_amount")


@query
def streamed_orders(m: Marts) -> DataFrame:
    """A topic into raw and on into refined, in micro-batches; a restart of either adds nothing.

    The topic is sent in two halves, with rows of one key in any of them, and either stream takes half of its files at a
    time, however large they are.
    """
    topic, offsets, seen = (scratch_path(m.spark, n) for n in ("topic", "offsets", "seen"))
    lake = Lake(scratch_path(m.spark, "streamed"))
    kept = history.FactHistory(m.spark, lake.path("history", "orders"), "orders", buckets=16)
    with shuffles_freed(m.spark):
        with passing_tables(m.spark) as written:
            # Written once, and dealt to the halves without a shuffle of all messages.
            sent = _with_corrections(written(m.raw("orders"), "sent"))
            half = F.pmod(F.xxhash64(*sent.columns), F.lit(2))
            for i in range(2):
                encode_events(sent.filter(half == i), "orders").write.mode("append").text(topic, compression=LANDED_AS)
        landed = lake.stream_path("orders")
        for _ in range(2):
            messages = file_topic(m.spark, topic, max_files_per_trigger=_half_of_files(m.spark, topic))
            ingest_stream(messages, landed, offsets, LANDED_AS).awaitTermination()
            rows = history.raw_stream(m.spark, landed, "orders", max_files_per_trigger=_half_of_files(m.spark, landed))
            kept.follow(rows, seen).awaitTermination()
    return kept.read()


def _half_of_files(spark: SparkSession, path: str) -> int:
    return max(1, (len(spark.read.text(path).inputFiles()) + 1) // 2)


# --- metrics and joins --------------------------------------------------------------------


@query
def order_metrics(m: Marts) -> DataFrame:
    return rounded(metrics.order_metrics(m.table("refined.orders")), "avg_order_amount")


@query
def return_metrics(m: Marts) -> DataFrame:
    return metrics.return_metrics(m.table("refined.returns"))


@query
def complaint_metrics(m: Marts) -> DataFrame:
    return metrics.complaint_metrics(m.table("refined.complaints"))


@query
def seller_aggregates(m: Marts) -> DataFrame:
    """The whole chain in one plan, from the source tables, nothing written between."""
    clean = {t: normalize.NORMALIZERS[t](m.raw(t)) for t in RAW_TABLES}
    joined = metrics.seller_aggregates(
        clean["sellers"], clean["orders"], clean["returns"], clean["complaints"]
    )
    return rounded(joined, "avg_order_amount")


@query
def orders_with_returns(m: Marts) -> DataFrame:
    return activity.orders_with_returns(m.table("refined.orders"), m.table("refined.returns"))


# --- risk model ---------------------------------------------------------------------------


@query
def risk_components(m: Marts) -> DataFrame:
    parts = scoring.risk_components(m.table("refined.seller_aggregates"), AS_OF)
    return parts.select(
        "seller_id", "complaint_rate", "high_severity_rate", "days_active", *scoring.COMPONENTS
    )


def _scored(m: Marts) -> DataFrame:
    return scoring.score(m.table("refined.seller_aggregates"), AS_OF)


@query
def seller_risk(m: Marts) -> DataFrame:
    return rounded(
        scoring.seller_risk(_scored(m)), "avg_order_amount", "risk_score", "risk_index"
    )


@query
def fraud_patterns(m: Marts) -> DataFrame:
    return rounded(fraud.fraud_patterns(_scored(m), AS_OF), "indicator_value")


# --- investigations -----------------------------------------------------------------------


@query
def q01_high_risk(m: Marts) -> DataFrame:
    return rounded(investigate.high_risk(_risk(m)), "risk_score")


@query
def q02_suspicious_returns(m: Marts) -> DataFrame:
    return rounded(investigate.suspicious_returns(_risk(m)), "risk_score")


@query
def q03_high_severity(m: Marts) -> DataFrame:
    return investigate.repeated_high_severity(_risk(m))


@query
def q04_fraud_patterns(m: Marts) -> DataFrame:
    return rounded(investigate.latest_fraud(_fraud(m)), "indicator_value")


@query
def q05_unverified_risky(m: Marts) -> DataFrame:
    return rounded(investigate.unverified_risky(_risk(m)), "risk_score")


@query
def q06_complaint_breakdown(m: Marts) -> DataFrame:
    return investigate.complaint_breakdown(m.table("refined.complaints"))


@query
def q07_daily_volume(m: Marts) -> DataFrame:
    return rounded(investigate.daily_volume(m.table("refined.orders")), "daily_revenue")


@query
def q07_daily_spikes(m: Marts) -> DataFrame:
    """Days above the seller's usual volume; one order more than usual counts here, so that days show up at every size."""
    return investigate.daily_spikes(m.table("refined.orders"), days=28, times=3.0, least_orders=2)


@query
def q08_returns_and_complaints(m: Marts) -> DataFrame:
    return rounded(investigate.returns_and_complaints(_risk(m)), "risk_score")


@query
def q09_seller_profile(m: Marts) -> DataFrame:
    one = investigate.seller_profile(_risk(m), _fraud(m), SELLER)
    return rounded(one, "avg_order_amount", "risk_score")


@query
def q09_all_profiles(m: Marts) -> DataFrame:
    every = investigate.seller_profile(_risk(m), _fraud(m))
    return rounded(every, "avg_order_amount", "risk_score")


@query
def q06_by_name(m: Marts) -> DataFrame:
    return by_name.complaint_breakdown(m.published())


@query
def q09_by_name(m: Marts) -> DataFrame:
    one = by_name.seller_profile(m.published(), SELLER)
    return rounded(one, "avg_order_amount", "risk_score")


@query
def q10_top10(m: Marts) -> DataFrame:
    return rounded(investigate.top_sellers(_risk(m)), "risk_score")


@query
def nb_high_risk(m: Marts) -> DataFrame:
    return rounded(investigate.high_risk_brief(_risk(m)), "risk_score")


@query
def nb_seller_risk(m: Marts) -> DataFrame:
    one = investigate.of_seller(_risk(m), SELLER)
    return rounded(one, "avg_order_amount", "risk_score", "risk_index")


@query
def nb_seller_fraud(m: Marts) -> DataFrame:
    return rounded(investigate.of_seller(_fraud(m), SELLER), "indicator_value")


@query
def nb_score_distribution(m: Marts) -> DataFrame:
    return rounded(investigate.score_distribution(_risk(m)), "risk_score")


@query
def nb_scatter(m: Marts) -> DataFrame:
    return investigate.return_complaint_scatter(_risk(m))


# --- reports and drill-downs --------------------------------------------------------------


@query
def headline_kpis(m: Marts) -> DataFrame:
    return rounded(reports.headline_kpis(_risk(m)), "avg_risk_score")


@query
def region_cards(m: Marts) -> DataFrame:
    return rounded(reports.region_cards(_risk(m)), "total_risk_index", "mean_risk_index")


@query
def region_members(m: Marts) -> DataFrame:
    return reports.region_members(_risk(m))


@query
def priority_list(m: Marts) -> DataFrame:
    return reports.priority_list(_risk(m))


@query
def fraud_table(m: Marts) -> DataFrame:
    return reports.fraud_table(_fraud(m))


@query
def chart_seller_scores(m: Marts) -> DataFrame:
    return reports.seller_score_series(_risk(m))


@query
def chart_region_index(m: Marts) -> DataFrame:
    return reports.region_index_series(_risk(m))


@query
def customer_activity(m: Marts) -> DataFrame:
    every = activity.customer_activity(m.table("refined.orders"), m.table("refined.returns"))
    return rounded(every, "total_amount")


@query
def customer_activity_seller(m: Marts) -> DataFrame:
    for name in ("refined.orders", "refined.returns"):
        m.table(name)
    facts = [m.run.read_seller(name, SELLER) for name in ("refined.orders", "refined.returns")]
    one = activity.customer_activity(*facts, SELLER)
    return rounded(one, "total_amount")


@query
def layer_counts(m: Marts) -> DataFrame:
    return activity.layer_counts(m.raw("orders"), m.table("refined.orders"), _risk(m))


@query
def event_counts(m: Marts) -> DataFrame:
    return activity.event_counts(m.raw("orders"), m.raw("returns"), m.raw("complaints"))


# --- governance ---------------------------------------------------------------------------


@query
def quality_orders(m: Marts) -> DataFrame:
    return quality.quality_orders(m.table("refined.orders"))


@query
def quality_returns(m: Marts) -> DataFrame:
    return quality.quality_returns(m.table("refined.returns"))


@query
def quality_complaints(m: Marts) -> DataFrame:
    return quality.quality_complaints(m.table("refined.complaints"))


@query
def quality_raw_orders(m: Marts) -> DataFrame:
    """The same check before refining, where it has something to find."""
    return quality.quality_orders(normalize.typed_orders(m.raw("orders")))


@query
def quality_report(m: Marts) -> DataFrame:
    return governance.quality_report(
        m.table("refined.orders"), m.table("refined.returns"), m.table("refined.complaints")
    )


@query
def mask_customers(m: Marts) -> DataFrame:
    return roles.mask_customers(m.table("refined.orders"))


@query
def role_ts_orders(m: Marts) -> DataFrame:
    return roles.role_view(roles.TRUST_SAFETY, "refined.orders", m.table("refined.orders"))


@query
def role_business_view(m: Marts) -> DataFrame:
    return roles.role_view(roles.BUSINESS, "curated.seller_risk", _risk(m))


@query
def access_report(m: Marts) -> DataFrame:
    named = {name: m.table(name) for name in pipeline.PUBLISHED}
    named["raw.orders"] = m.raw("orders")
    return governance.access_report(named)


@query
def duplicates_across_runs(m: Marts) -> DataFrame:
    """Duplicates over three runs: counted, and whether the estimate from the runs' merged sketches is as near as it says."""
    # Written once, not put together for every run.
    typed = materialize(normalize.typed_orders(_corrected_orders(m)), "typed-orders")
    part = F.pmod(F.xxhash64(*typed.columns), F.lit(3))
    runs = [quality.key_sketch(typed.filter(part == i), "refined.orders", "order_id") for i in range(3)]
    kept = reduce(DataFrame.unionByName, runs)
    exact = quality.quality_orders(typed).select("table_name", "total_rows", "duplicate_rows")
    both = exact.unionByName(quality.merged_duplicates(kept), allowMissingColumns=True)
    names = ["duplicate_rows", "duplicate_estimate", "error_bound", "total_rows"]
    one = both.groupBy("table_name").agg(*[F.max(n).alias(n) for n in names])
    off = F.abs(F.col("duplicate_estimate") - F.col("duplicate_rows"))
    return one.select(
        "table_name", "total_rows", "duplicate_rows", (off <= F.col("error_bound")).alias("estimate_within_bound")
    )


@query
def rekeyed_customers(m: Marts) -> DataFrame:
    """Orders masked under two keys, one of them on its way out: customers are whole again under the new one."""
    orders = m.table("refined.orders")
    early = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    old, new = (rekey.MaskKey(i, s.encode()) for i, s in MASK_KEYS)
    both = rekey.mask_with_key(orders.filter(early), old).unionByName(rekey.mask_with_key(orders.filter(~early), new))
    moved = rekey.rekeyed(both, rekey.rekey_map(orders, old, new), new.key_id)
    counted = moved.groupBy("customer_id_masked", "mask_key_id").agg(
        F.count("*").alias("total_orders"), F.sum("amount").alias("total_amount")
    )
    return rounded(counted, "total_amount")


# --- pipelines ----------------------------------------------------------------------------


@query
def pipeline_run(m: Marts) -> DataFrame:
    """JSON landing to curated tables, checked, published and exported."""
    base = scratch_path(m.spark, "pipeline")
    landed = m.landed()
    for table in RAW_TABLES:
        land_files(m.spark, landed.path("raw", table), f"{base}/raw/{table}/{table}.json", LANDED_AS)
    catalog = Catalog(m.spark, f"p{base.rsplit('-', 1)[-1][:8]}_", f"{base}/warehouse")
    return pipeline.run_pipeline(
        m.spark, base, AS_OF, catalog=catalog, export_path=f"{base}/export"
    )
