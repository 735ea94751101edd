"""What the physical plans have to look like, whatever the data size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sellerlens.checks import registry
from sellerlens.checks.marts import marts
from sellerlens.operators import ranking
from sellerlens.operators.dedupe import latest_per_key
from sellerlens.operators.metrics import seller_aggregates
from sellerlens.plans import activity, investigate, reports
from sellerlens.sources.files import Lake, file_spans, read_ranged, read_table, write_laid_out, write_table
from sellerlens.checks.registry import all_queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_on_both_sides_of_the_one_shuffle(table):
    text = plan(latest_per_key(table("refined.orders"), "order_id", "event_ts"))
    steps = re.findall(r"WindowGroupLimit|Exchange|Window(?= )", text)
    assert steps == ["Window", "WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_dedupe_leaves_rows_where_they_are_dealt_by_what_the_key_determines(table):
    rows = [{"order_id": f"O{i % 7}", "seller_id": f"S{i}", "customer_id": f"C{i % 3}"} for i in range(40)]
    orders = table("refined.orders", *rows).withColumn("_share", F.pmod(F.hash("order_id"), F.lit(3)))
    dealt = latest_per_key(orders.repartition("_share"), "order_id", "event_ts", ("_share",))
    assert plan(dealt).count("Exchange") == 1
    assert sorted(map(str, dealt.collect())) == sorted(map(str, latest_per_key(orders, "order_id", "event_ts").collect()))


def test_aggregates_shuffle_each_fact_once(spark, table):
    facts = [table(f"refined.{t}") for t in ("sellers", "orders", "returns", "complaints")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(seller_aggregates(*facts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange hashpartitioning(seller_id") == 4
    assert text.count("Exchange") == 4
    assert text.count("partial_") >= 3


def test_seller_lookup_reaches_the_scan_with_few_columns(spark, tmp_path, table):
    lake = Lake(str(tmp_path))
    for name in ("orders", "returns"):
        write_table(table(f"refined.{name}"), lake, "refined", name)
    orders = read_table(spark, lake, "refined", "orders")
    returns = read_table(spark, lake, "refined", "returns")
    text = plan(activity.customer_activity(orders, returns, "S1"))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert len(pushed) == 2 and all("EqualTo(seller_id,S1)" in p for p in pushed)
    keys = "order_id:string,seller_id:string"
    assert f"ReadSchema: struct<{keys},customer_id:string,amount:double>" in text
    assert f"ReadSchema: struct<{keys}>" in text


def scanned_files(df) -> int:
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_seller_lookup_opens_few_files_though_one_seller_has_a_third(spark, tmp_path, table):
    lake, files = Lake(str(tmp_path)), 200
    hot = F.when(F.col("id") % 3 == 0, "S0").otherwise(F.concat(F.lit("S"), F.col("id") % 900))
    rows = spark.range(30_000).select(
        F.format_string("O%06d", F.col("id")).alias("order_id"), hot.alias("seller_id"), F.lit("C").alias("customer_id"),
        F.lit(1.0).alias("amount"), F.lit(None).cast("timestamp").alias("event_ts"), F.lit("a").alias("status"),
        F.lit("b").alias("category"),
    )
    write_laid_out(rows, lake, "refined", "orders", ("seller_id", "order_id"), files)
    index = spark.read.parquet(lake.index_path("refined", "orders"))
    assert index.count() > 190 and index.agg(F.sum("row_count")).first()[0] == 30_000
    assert index.agg(F.max("row_count")).first()[0] < 30_000 / 50  # the hot seller is spread
    for seller in ("S5", "S899", "S301"):
        found = read_ranged(spark, lake, "refined", "orders", seller)
        assert found.count() == rows.where(F.col("seller_id") == seller).count() > 0
        assert scanned_files(found) <= 0.05 * files
    assert read_ranged(spark, lake, "refined", "orders", "S0").count() == rows.where("seller_id = 'S0'").count()
    assert read_ranged(spark, lake, "refined", "orders", "none").count() == 0
    # Files that change take the index with them; without one the whole table is looked through.
    write_table(rows.limit(10), lake, "refined", "orders")
    assert read_ranged(spark, lake, "refined", "orders", "S0").count() == rows.limit(10).where("seller_id = 'S0'").count()


def test_spikes_cut_a_seller_with_very_many_days(table):
    text = plan(investigate.daily_spikes(table("refined.orders")))
    assert re.search(r"Window \[collect_list.*\], \[seller_id#\d+, stretch#\d+L\]", text)


def test_spikes_are_judged_once(table):
    """No sort of a day's counts inside the loop over them, and only spikes are looked at for the ranges of the last sort."""
    text = plan(investigate.daily_spikes(table("refined.orders")))
    assert "array_sort" not in text and text.count("collect_list") < 12
    assert re.search(r"Exchange hashpartitioning\(order_date#\d+, \d+\), REPARTITION_BY_COL", text)


def test_metrics_scan_no_id_columns(spark, tmp_path, table):
    lake = Lake(str(tmp_path))
    facts = []
    for name in ("sellers", "orders", "returns", "complaints"):
        write_table(table(f"refined.{name}"), lake, "refined", name)
        facts.append(read_table(spark, lake, "refined", name))
    text = plan(seller_aggregates(*facts))
    for read in (
        "struct<seller_id:string,amount:double>",
        "struct<seller_id:string>",
        "struct<seller_id:string,severity:string>",
    ):
        assert f"ReadSchema: {read}" in text


def test_top_sellers_is_a_top_k(table):
    assert "TakeOrderedAndProject" in plan(investigate.top_sellers(table("curated.seller_risk")))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    text = plan(all_queries()[name](spark, SF))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert unwanted not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            assert "SinglePartition" not in "".join(lines[i + 1 : i + 5])


def test_priorities_sort_the_sellers_once_in_all_their_jobs(table, monkeypatch):
    written, write = [], ranking.materialize

    def spy(df, label):
        written.append(plan(df))
        return write(df, label)

    monkeypatch.setattr(ranking, "materialize", spy)
    rows = [{"seller_id": f"S{i}", "risk_score": float(i)} for i in range(9)]
    last = plan(reports.priority_list(table("curated.seller_risk", *rows)))
    assert len(written) == 2
    assert sum(text.count("rangepartitioning") for text in [*written, last]) == 1
    assert "SinglePartition" not in written[0]


def test_corrected_orders_are_put_together_once(spark):
    text = plan(registry._corrected_orders(marts(spark, "/root/testdata/sf0.001")))
    assert len(re.findall(r"FileScan parquet", text)) == 3


def test_lines_meet_their_orders_last_and_unsorted(spark):
    """Repeats of an order id are side by side before they are shuffled by it; lines are not sorted to be joined."""
    text = plan(marts(spark, SF).raw("orders"))
    joins = re.findall(r"(\w+Join) \[([a-z]_\w+)#", text)
    assert joins[0] == ("ShuffledHashJoin", "l_orderkey") and [key for _, key in joins] == ["l_orderkey", "l_partkey"]
    assert "Sort [l_orderkey" not in text


def test_shuffles_are_as_wide_as_the_source_tables_are_large(spark, monkeypatch):
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    m = marts(spark, SF)
    try:
        assert spark.conf.get(name) == before  # small tables change nothing
        for size, wanted in ((60 * 2**23, "60"), (10 * 2**23, "60"), (1000 * 2**40, "40000")):
            monkeypatch.setattr(m, "source_bytes", size)
            marts(spark, SF)
            assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)


def test_file_spans_do_not_sort_the_rows(spark):
    data = [("a", "S2"), ("a", "S10"), ("a", "S2"), ("b", "S3")]
    spans = file_spans(spark.createDataFrame(data, "file STRING, seller_id STRING"), "seller_id")
    of_rows = plan(spans).split("Exchange")[-1]
    assert "HashAggregate" in of_rows and "Sort" not in of_rows
    assert sorted(map(tuple, spans.collect())) == [("a", "S10", "S2", 3), ("b", "S3", "S3", 1)]
