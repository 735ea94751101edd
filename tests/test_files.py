from __future__ import annotations

import json
import os
import shutil
from dataclasses import replace
from datetime import timedelta

import pytest

from sellerlens.checks.marts import marts
from sellerlens.plans import by_name
from sellerlens.plans.pipeline import PUBLISHED, Run, published_counts, run_pipeline
from sellerlens.schemas import LAYERS, columns, tables
from sellerlens.session import sized_for
from sellerlens.sources import pointers
from sellerlens.sources.catalog import Catalog
from sellerlens.sources.files import (
    Lake,
    PublishGateError,
    export_json,
    finished_runs,
    forget_runs,
    land_files,
    publish_gate,
    read_json_lines,
    read_raw,
    read_table,
    write_table,
)
from sellerlens.streaming.ingest import file_topic, ingest_stream
from sellerlens.sources.scratch import materialize, scratch_path, scratch_root
from tests.conftest import AS_OF, by, dicts

# Fixed sample values of two shipped sellers, here and in the lake fixture.
ORDER = {
    "order_id": "O1",
    "seller_id": "S58",
    "customer_id": "C150",
    "amount": 450.0,
    "timestamp": "2026-04-28T10:00:00",
    "status": "completed",
    "category": "electronics",
}


def write(path, *lines: str):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


@pytest.fixture
def lake(tmp_path):
    """A small but complete raw layer."""
    lake = Lake(str(tmp_path))
    write(
        lake.path("raw", "orders") + "/orders.json",
        json.dumps(ORDER),
        json.dumps({**ORDER, "order_id": "O2", "amount": "12"}),
        json.dumps({**ORDER, "order_id": "O2", "timestamp": "2026-04-29T10:00:00.5"}),
        json.dumps({**ORDER, "order_id": "O3", "amount": 10000}),
        '{"order_id": "O4", "seller_id"',
        "null",
    )
    write(
        lake.path("raw", "orders") + "/more/late.json",
        json.dumps({**ORDER, "order_id": "O5", "extra": [1]}),
    )
    write(
        lake.path("raw", "returns") + "/returns.json",
        json.dumps({"return_id": "R1", "order_id": "O1", "seller_id": "S58", "status": "approved",
                    "timestamp": "2026-04-28T10:00:00", "reason": "Counterfeit"}),
    )
    write(
        lake.path("raw", "complaints") + "/complaints.json",
        json.dumps({"complaint_id": "CMP1", "seller_id": "S58", "severity": "HIGH",
                    "timestamp": "2026-04-28T10:00:00", "category": "fraud"}),
    )
    write(
        lake.path("raw", "sellers") + "/sellers.json",
        json.dumps({"seller_id": "S58", "seller_name": "BudgetFinds", "region": "Middle East",
                    "registration_date": "2024-11-01", "category": "electronics",
                    "verification_status": "unverified", "support_tier": "basic"}),
        json.dumps({"seller_id": "S57", "seller_name": "MegaSupplies", "region": "Asia",
                    "registration_date": "2022-07-20", "category": "home_goods",
                    "verification_status": "verified", "support_tier": "silver"}),
    )
    return lake


def test_raw_scan_keeps_malformed_lines_and_nested_files(spark, lake):
    rows = read_json_lines(spark, lake.path("raw", "orders"), "orders").cache()
    assert rows.columns == [*columns("raw.orders"), "_corrupt_record"]
    found = [(r.order_id, r.amount) for r in rows.collect()]
    assert ("O2", "12") in found and ("O1", "450.0") in found and ("O5", "450.0") in found
    broken = [r for r in rows.collect() if r.order_id is None]
    assert broken and all(r.seller_id is None for r in broken)
    assert any(r._corrupt_record for r in broken)
    rows.unpersist()


def test_missing_raw_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, Lake(str(tmp_path / "none")), "orders")


def test_parquet_overwrite(spark, tmp_path, table):
    lake = Lake(str(tmp_path))
    for _ in range(2):
        write_table(
            table("refined.orders", {"order_id": "1"}, {"order_id": "2"}),
            lake, "refined", "orders", cluster_by=("seller_id",),
        )
    assert read_table(spark, lake, "refined", "orders").count() == 2


def test_land_files_is_a_line_copy(spark, tmp_path):
    source, target = str(tmp_path / "in" / "a.json"), str(tmp_path / "out" / "a.json")
    write(source, '{"a": 1}', "not json\r", "", "  null ")
    for _ in range(2):
        land_files(spark, source, target)
    parts = sorted(p for p in os.listdir(target) if p.startswith("part-"))
    landed = b"".join(open(os.path.join(target, p), "rb").read() for p in parts)
    assert landed == open(source, "rb").read()


def test_export_writes_nulls(spark, tmp_path, table):
    path = export_json(table("curated.seller_risk", {"seller_id": "A"}), str(tmp_path / "x"))
    (line,) = spark.read.text(path).collect()
    assert json.loads(line.value)["risk_label"] is None


def test_gate(spark, tmp_path, table):
    lake = Lake(str(tmp_path))
    with pytest.raises(PublishGateError):
        publish_gate(spark, lake, "curated", "seller_risk")
    (row,) = dicts(publish_gate(spark, lake, "curated", "seller_risk", must_pass=False))
    assert (row["table_exists"], row["row_count"], row["schema_ok"]) == (False, 0, False)
    write_table(table("curated.seller_risk"), lake, "curated", "seller_risk")
    with pytest.raises(PublishGateError):
        publish_gate(spark, lake, "curated", "seller_risk")
    write_table(spark.range(3), lake, "curated", "seller_risk")
    with pytest.raises(PublishGateError):
        publish_gate(spark, lake, "curated", "seller_risk")
    write_table(table("curated.seller_risk", {"seller_id": "A"}), lake, "curated", "seller_risk")
    (row,) = dicts(publish_gate(spark, lake, "curated", "seller_risk"))
    assert (row["table_exists"], row["row_count"], row["schema_ok"]) == (True, 1, True)


def test_pipeline_end_to_end(spark, lake, tmp_path):
    catalog = Catalog(spark, prefix="e2e_", location=str(tmp_path / "warehouse"))
    checked = by(
        run_pipeline(spark, lake.base, AS_OF, catalog=catalog, export_path=str(tmp_path / "out")),
        "table_name",
    )
    assert checked["curated.seller_risk"]["row_count"] == 2
    run = Run(spark, lake, AS_OF)
    orders = by(run.read("refined.orders"), "order_id")
    assert set(orders) == {"O1", "O2", "O5"}
    assert orders["O2"]["amount"] == 450.0
    risk = by(run.read("curated.seller_risk"), "seller_id")
    assert (risk["S58"]["total_orders"], risk["S58"]["total_returns"]) == (3, 1)
    assert risk["S57"]["total_orders"] == 0
    assert len(risk) == run.read("refined.sellers").count()
    fraud = run.read("curated.fraud_patterns")
    assert {r.seller_id for r in fraud.collect()} <= set(risk)
    published = {r.table_name: r.row_count for r in published_counts(catalog).collect()}
    assert published["refined.orders"] == 3 and set(published) == set(PUBLISHED)
    assert [r.seller_id for r in catalog.sellers_by_risk().collect()] == ["S58", "S57"]
    listed = {f"{r.layer}.{r.table_name}" for r in catalog.list_tables().collect()}
    assert listed == set(PUBLISHED)
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    # A second run replaces, it does not add, and names show the new files.
    write(lake.path("raw", "orders") + "/new.json", json.dumps({**ORDER, "order_id": "O9"}))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    assert catalog.table("curated.seller_risk").count() == 2
    assert catalog.table("refined.orders").count() == 4
    # What was read from the first run still is that run's; a copy stays as it was when the files change.
    assert run.read("refined.orders").count() == 3
    run = Run(spark, lake, AS_OF)
    run.publish(catalog, copy_facts=True)
    write(lake.path("raw", "orders") + "/newer.json", json.dumps({**ORDER, "order_id": "O10"}))
    run.refine("orders")
    assert run.read("refined.orders").count() == 5
    assert catalog.table("refined.orders").count() == 4


def test_tables_by_name(spark, lake):
    run_pipeline(spark, lake.base, AS_OF)
    catalog = Catalog(spark, prefix="named_", location=f"{lake.base}/it's db")
    for _ in range(2):
        catalog.register_raw(lake)
        catalog.register_refined(lake)
        catalog.register_curated(lake)
    listed = {(r.layer, r.table_name) for r in catalog.list_tables().collect()}
    assert listed == {(layer, t) for layer in LAYERS for t in tables(layer)}
    assert catalog.table("raw.sellers").count() == 2
    assert catalog.table("refined.orders").count() == 3
    high = spark.sql(
        f"SELECT seller_id FROM {catalog.name('curated.seller_risk')} WHERE seller_id = :id",
        args={"id": "S58"},
    )
    assert high.count() == 1


def test_a_failed_run_changes_nothing_and_a_good_one_everything(spark, lake, tmp_path):
    catalog = Catalog(spark, prefix="gate_", location=str(tmp_path / "warehouse"))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)

    def answers():
        by_path = {n: sorted(map(str, Run(spark, lake).read(n).collect())) for n in PUBLISHED}
        by_name = {n: sorted(map(str, catalog.table(n).collect())) for n in PUBLISHED}
        assert by_path == by_name
        return by_path

    first = answers()
    folder = lake.path("raw", "sellers")
    files = {f: open(f"{folder}/{f}").read() for f in os.listdir(folder) if not f.startswith((".", "_"))}
    for f in files:
        write(f"{folder}/{f}", "")
    write(lake.path("raw", "orders") + "/more.json", json.dumps({**ORDER, "order_id": "O98"}))
    with pytest.raises(PublishGateError):
        run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    assert answers() == first
    for f, text in files.items():
        write(f"{folder}/{f}", text)
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    second = answers()
    assert len(second["refined.orders"]) == len(first["refined.orders"]) + 1
    assert second["curated.seller_risk"] != first["curated.seller_risk"]
    assert len(finished_runs(spark, lake)) == 2
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog, keep_runs=1)
    assert answers() == second
    done = finished_runs(spark, lake)
    left = [r for r in done if os.path.isdir(lake.run_path(r))]
    assert left == done[-1:]


def counts_by_name(spark, catalog):
    """Rows of every published name, in one query."""
    union = " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {catalog.name(n)}" for n in PUBLISHED)
    return {r.name: r.n for r in spark.sql(union).collect()}


def counts_by_path(spark, lake):
    run = Run(spark, lake)
    return {n: run.read(n).count() for n in PUBLISHED}


def test_names_show_one_run_wherever_publishing_stops(spark, lake, tmp_path, monkeypatch):
    catalog = Catalog(spark, prefix="kill_", location=str(tmp_path / "warehouse"))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    old = counts_by_name(spark, catalog)
    assert old == counts_by_path(spark, lake)
    for table, more in (
        ("orders", {**ORDER, "order_id": "O50"}),
        ("returns", {"return_id": "R50", "order_id": "O50", "seller_id": "S57"}),
        ("complaints", {"complaint_id": "C50", "seller_id": "S57", "severity": "high"}),
        ("sellers", {"seller_id": "S1", "seller_name": "New", "verification_status": "unverified"}),
    ):
        write(lake.path("raw", table) + "/more.json", json.dumps(more))
    run_pipeline(spark, lake.base, AS_OF)
    new = counts_by_path(spark, lake)
    assert all(new[n] > old[n] for n in PUBLISHED if n != "curated.fraud_patterns")

    steps, sql, entry = [], Catalog._run, pointers.add_entry

    class Killed(Exception):
        pass

    def stop_after(limit):
        def step(work):
            def counted(*args):
                if len(steps) == limit:
                    raise Killed
                work(*args)
                steps.append(args[-1])

            return counted

        steps.clear()
        monkeypatch.setattr(Catalog, "_run", step(sql))
        monkeypatch.setattr(pointers, "add_entry", step(entry))

    for limit in range(100):
        stop_after(limit)
        try:
            catalog.show_run(lake, PUBLISHED)
            break
        except Killed:
            assert counts_by_name(spark, catalog) == old, f"after {limit} steps: {steps}"
    assert limit > len(PUBLISHED) and counts_by_name(spark, catalog) == new


def test_readers_stay_with_their_run(spark, lake, tmp_path):
    catalog = Catalog(spark, prefix="pin_", location=str(tmp_path / "warehouse"))
    with pytest.raises(LookupError):
        catalog.pinned()
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    run, pinned = Run(spark, lake), catalog.pinned()
    first = {n: run.read(n).count() for n in PUBLISHED[:1]}  # the run is resolved by its first read
    write(lake.path("raw", "orders") + "/new.json", json.dumps({**ORDER, "order_id": "O51"}))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    assert first and run.read("refined.orders").count() == 3 == counts_by_name(spark, pinned)["refined.orders"]
    assert by_name.seller_profile(pinned, "S58").first().total_orders == 3
    assert by_name.seller_profile(catalog, "S58").first().total_orders == 4
    assert counts_by_name(spark, catalog) == counts_by_path(spark, lake) and pinned.table("refined.orders").count() == 3
    with pytest.raises(TypeError):
        pinned.show_run(lake, PUBLISHED)
    # An older run can be shown again.
    catalog.show_run(replace(lake, run=finished_runs(spark, lake)[0]), PUBLISHED)
    assert counts_by_name(spark, catalog)["refined.orders"] == 3


def test_reading_a_run_starts_no_job_for_the_pointer(spark, lake):
    run_pipeline(spark, lake.base, AS_OF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pointer", "")
    try:
        Run(spark, lake).read("curated.seller_risk")
        assert list(tracker.getJobIdsForGroup("pointer")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_old_runs_go_but_for_those_in_use(spark, lake, tmp_path):
    catalog = Catalog(spark, prefix="keep_", location=str(tmp_path / "warehouse"))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog)
    shown = finished_runs(spark, lake)[0]
    for _ in range(2):
        run_pipeline(spark, lake.base, AS_OF)
    every = finished_runs(spark, lake)
    assert forget_runs(spark, lake, 1, timedelta(hours=1)) == []
    assert forget_runs(spark, lake, 1, held=[catalog.shown_run()]) == every[1:2]
    assert finished_runs(spark, lake) == [shown, every[-1]]
    assert [os.path.isdir(lake.run_path(r)) for r in every] == [True, False, True]
    assert counts_by_name(spark, catalog) == counts_by_path(spark, replace(lake, run=shown))
    run_pipeline(spark, lake.base, AS_OF, catalog=catalog, keep_runs=1)
    assert counts_by_name(spark, catalog) == counts_by_path(spark, lake) and len(finished_runs(spark, lake)) == 1
    runs = spark.sql(f"SHOW PARTITIONS {catalog._runs('refined.orders')}").collect()
    assert [r.partition for r in runs] == [f"run={catalog.shown_run()}"]


def test_raw_names_answer_while_they_move_to_another_lake(spark, lake, tmp_path, monkeypatch):
    catalog = Catalog(spark, prefix="rawmove_", location=str(tmp_path / "warehouse"))
    catalog.register_raw(lake)
    other = Lake(str(tmp_path / "other"))
    write(other.path("raw", "sellers") + "/s.json", json.dumps({"seller_id": "S1"}))
    counts, run = [], Catalog._run

    def watched(self, statement):
        run(self, statement)
        counts.append(self.table("raw.sellers").count())

    monkeypatch.setattr(Catalog, "_run", watched)
    catalog.register_raw(other)
    assert set(counts) == {2, 1} and counts == sorted(counts, reverse=True)
    monkeypatch.undo()
    catalog.register_raw(lake)
    assert catalog.table("raw.sellers").count() == 2


def test_a_name_with_other_columns_is_not_replaced(spark, lake, tmp_path):
    run_pipeline(spark, lake.base, AS_OF)
    catalog = Catalog(spark, prefix="other_", location=str(tmp_path / "warehouse"))
    catalog.ensure_layers()
    spark.range(1).write.option("path", str(tmp_path / "x")).saveAsTable(catalog.name("refined.orders"))
    with pytest.raises(ValueError, match="other columns"):
        catalog.register_refined(lake)


def test_raw_by_name_holds_landed_files_and_the_stream(spark, lake, tmp_path):
    catalog = Catalog(spark, prefix="raws_", location=str(tmp_path / "warehouse"))
    catalog.register_raw(lake)
    landed = catalog.table("raw.orders").count()
    topic = tmp_path / "topic"
    topic.mkdir()
    write(str(topic / "a.json"), json.dumps({**ORDER, "order_id": "O97"}))

    def drain():
        messages = file_topic(spark, str(topic))
        ingest_stream(messages, lake.stream_path("orders"), str(tmp_path / "offsets")).awaitTermination()

    drain()
    drain()
    assert catalog.table("raw.orders").count() == landed + 1 == read_raw(spark, lake, "orders").count()
    # A file the commit log does not know is not part of the table.
    write(lake.stream_path("orders") + "/stray.txt", json.dumps({**ORDER, "order_id": "O96"}))
    assert catalog.table("raw.orders").count() == landed + 1


def test_scratch_is_the_sessions_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = materialize(spark.range(5), "numbers")
    assert kept.count() == 5 and "ExistingRDD" not in kept._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("size", "split", "partitions"),
    [(0, 2**27, 200), (2**40, 2**27, 4096), (100 * 2**40, 2**30, 40_000)],
)
def test_sizes_follow_the_input_within_bounds(size, split, partitions):
    conf = sized_for(size)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == split
    assert int(conf["spark.sql.shuffle.partitions"]) == partitions


def test_raw_tables_land_compressed_and_only_those_asked_for(spark, tmp_path):
    sf = str(tmp_path / "sf")
    shutil.copytree("/root/testdata/sf0.001", sf)
    m = marts(spark, sf)
    lake = m.landed("orders")
    assert read_json_lines(spark, lake.path("raw", "orders"), "orders").count() == m.raw("orders").count()
    assert not os.path.exists(lake.path("raw", "returns"))
    copied = land_files(spark, lake.path("raw", "orders"), str(tmp_path / "copy"), "gzip")
    for folder in (lake.path("raw", "orders"), copied):
        data = [name for name in os.listdir(folder) if name.startswith("part-")]
        assert data and all(name.endswith(".gz") for name in data)
    assert spark.read.text(copied).count() == m.raw("orders").count()
