"""Facts kept up to date batch by batch, against refining everything at once."""

from __future__ import annotations

import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from sellerlens.operators import metrics
from sellerlens.operators.normalize import NORMALIZERS
from sellerlens.plans import history
from sellerlens.schemas import schema
from sellerlens.session import shuffles_freed
from sellerlens.sources import pointers
from sellerlens.sources.scratch import passing_tables, scratch_path, scratch_root
from tests.conftest import dicts


def raw_orders(spark, rows):
    return spark.createDataFrame(rows, schema("raw.orders"))


def order(key, seller="S1", amount="10", day=1, customer="C1"):
    return (key, seller, customer, amount, f"2026-01-{day:02d}T00:00:00", "completed", "x")


def rows_of(df):
    return sorted(map(str, dicts(df.select(sorted(df.columns)))))


def files_of(history_, held=None):
    """Every file that counts, with its inode."""
    found = {}
    for bucket, versions in (held or history_.files()).items():
        for version in versions:
            folder = f"{history_.root}/files/{version}/bucket={bucket}"
            found.update({f"{folder}/{f}": os.stat(f"{folder}/{f}").st_ino for f in os.listdir(folder) if f.endswith(".parquet")})
    return found


@pytest.fixture
def orders(spark, tmp_path):
    return history.FactHistory(spark, str(tmp_path / "orders"), "orders", buckets=4)


def test_any_split_into_batches_gives_the_full_refine(spark, tmp_path):
    rng = random.Random(3)
    rows = [
        order(rng.choice([None, *[f"O{i}" for i in range(25)]]), rng.choice(["S1", "S1", "S2", "S3", None]),
              rng.choice(["5", "7.25", "12.333", "x", None, "-1", "99999"]), rng.randint(1, 4), rng.choice(["C1", "C2", None]))
        for _ in range(160)
    ]
    full = NORMALIZERS["orders"](raw_orders(spark, rows))
    want, sums = rows_of(full), {r["seller_id"]: r for r in metrics.order_metrics(full).collect()}
    for trial, cuts in enumerate(([0, 160], [0, 1, 80, 160], [0, 40, 40, 120, 160])):
        kept = history.FactHistory(spark, str(tmp_path / f"h{trial}"), "orders", buckets=3)
        rng.shuffle(rows)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            kept.absorb(raw_orders(spark, rows[a:b]), f"b{i}")
        assert rows_of(kept.read()) == want
        got = {r["seller_id"]: r for r in kept.metrics().collect()}
        assert set(got) == set(sums)
        for seller, r in got.items():
            assert r["total_orders"] == sums[seller]["total_orders"]
            assert r["avg_order_amount"] == pytest.approx(sums[seller]["avg_order_amount"], rel=1e-9)


def test_buckets_without_a_replaced_row_keep_their_files(spark, orders):
    orders.absorb(raw_orders(spark, [order(f"O{i}") for i in range(40)]), "first")
    before, was = orders.files(), files_of(orders)
    hit = orders.read().where("order_id = 'O7'").select(orders._bucket().alias("b")).first().b
    orders.absorb(raw_orders(spark, [order("O7", amount="11", day=2), order("N1"), order("N2")]), "second")
    after, now = orders.files(), files_of(orders)
    assert before[hit][0] not in after[hit] and len(after[hit]) == 1
    for bucket in set(before) - {hit}:
        assert before[bucket][0] in after[bucket]  # added beside it, at most
    kept = {p: i for p, i in was.items() if f"bucket={hit}/" not in p}
    assert kept and kept.items() <= now.items()
    # Nothing that wins: no file changes.
    orders.absorb(raw_orders(spark, [order("O7", amount="9", day=1), order("O8")]), "third")
    assert files_of(orders) == now


def test_a_batch_counts_once_and_a_failed_one_not_at_all(spark, orders, monkeypatch):
    first = raw_orders(spark, [order("A"), order("B", "S2")])
    orders.absorb(first, "one")
    orders.absorb(raw_orders(spark, [order("Z")]), "one")
    assert {r.order_id for r in orders.read().collect()} == {"A", "B"}
    more = raw_orders(spark, [order("A", "S2", day=3), order("C")])

    def fail(*_):
        raise OSError("killed before the last step")

    with monkeypatch.context() as patch:
        patch.setattr(pointers, "add_entry", fail)
        with pytest.raises(OSError):
            orders.absorb(more, "two")
    assert rows_of(orders.read()) == rows_of(NORMALIZERS["orders"](first))
    assert {r.seller_id: r.total_orders for r in orders.metrics().collect()} == {"S1": 1, "S2": 1}
    orders.absorb(more, "two")
    assert orders.batches() == ["one", "two"]
    # The corrected order left its first seller, who keeps the new one; then that one goes too.
    assert {r.seller_id: r.total_orders for r in orders.metrics().collect()} == {"S1": 1, "S2": 2}
    orders.absorb(raw_orders(spark, [order("C", "S2", day=4)]), "three")
    assert {r.seller_id: r.total_orders for r in orders.metrics().collect()} == {"S2": 3}


def test_many_small_batches_do_not_pile_up_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "MOST_VERSIONS", 3)
    kept = history.FactHistory(spark, str(tmp_path), "orders", buckets=1)
    for i in range(7):
        kept.absorb(raw_orders(spark, [order(f"O{i}")]), f"b{i}")
        assert len(kept.files()[0]) <= 3
    assert kept.read().count() == 7


def test_empty_and_fruitless_batches(spark, orders):
    assert orders.read().count() == 0 and orders.metrics().count() == 0
    orders.absorb(raw_orders(spark, []), "none")
    orders.absorb(raw_orders(spark, [order(None), order("A", None), order("A", amount="0")]), "bad")
    assert orders.read().count() == 0 and orders.metrics().count() == 0 and len(orders.batches()) == 2
    orders.absorb(raw_orders(spark, [order("A")]), "good")
    assert orders.read().count() == 1


def test_complaints_and_returns_and_the_joined_metrics(spark, tmp_path):
    complaints = [(f"C{i}", f"S{i % 3}", f"2026-01-0{1 + i % 9}T00:00:00", "HIGH" if i % 2 else "low", "fraud") for i in range(30)]
    calmed = [("C1", "S1", "2027-01-01T00:00:00", "low", "fraud")]
    returns = [(f"R{i}", f"O{i}", f"S{i % 2}", "2026-01-01T00:00:00", "x", "y") for i in range(9)]
    sellers = spark.createDataFrame([(f"S{i}",) + (None,) * 6 for i in range(4)], schema("refined.sellers"))
    open_ = {t: history.FactHistory(spark, str(tmp_path / t), t, 2) for t in history.FACTS}
    for i in range(3):
        open_["complaints"].absorb(spark.createDataFrame(complaints[i::3], schema("raw.complaints")), f"b{i}")
        open_["returns"].absorb(spark.createDataFrame(returns[i::3], schema("raw.returns")), f"b{i}")
    open_["complaints"].absorb(spark.createDataFrame(calmed, schema("raw.complaints")), "late")
    got = history.current_aggregates(sellers, open_.__getitem__)
    full = [NORMALIZERS[t](spark.createDataFrame(rows, schema(f"raw.{t}"))) for t, rows in
            (("orders", []), ("returns", returns), ("complaints", complaints + calmed))]
    assert rows_of(got) == rows_of(metrics.seller_aggregates(sellers, *full))


def test_a_stream_is_absorbed_in_micro_batches_and_a_restart_adds_nothing(spark, tmp_path, orders):
    source = tmp_path / "in"
    source.mkdir()

    def land(name, rows):
        raw_orders(spark, rows).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(str(tmp_path / name))
        for f in os.listdir(tmp_path / name):
            if f.startswith("part-"):
                os.rename(tmp_path / name / f, source / f"{name}.txt")

    def drain():
        rows = history.raw_stream(spark, str(source), "orders", max_files_per_trigger=1)
        orders.follow(rows, str(tmp_path / "seen")).awaitTermination()

    land("a", [order("A"), order("B")])
    land("b", [order("A", amount="20", day=5), order(None)])
    drain()
    drain()
    assert len(orders.batches()) == 2
    land("c", [order("C"), order("A", amount="30", day=2)])
    drain()
    assert {(r.order_id, r.amount) for r in orders.read().collect()} == {("A", 20.0), ("B", 10.0), ("C", 10.0)}


def shuffle_files(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (disks.apply(i).getName() for i in range(disks.size())) if n.startswith("shuffle_")}


def gone_after_a_while(find):
    until = time.time() + 20
    while find() and time.time() < until:
        time.sleep(0.2)
    return not find()


def test_a_batch_leaves_its_version_and_nothing_else(spark, orders):
    scratch = scratch_root(spark)
    os.makedirs(scratch, exist_ok=True)
    before, shuffled = set(os.listdir(scratch)), shuffle_files(spark)
    orders.absorb(raw_orders(spark, [order(f"O{i}") for i in range(40)]).repartition(3), "first")
    orders.absorb(raw_orders(spark, [order(f"O{i}", amount="11", day=2) for i in range(20, 60)]).repartition(3), "second")
    assert set(os.listdir(scratch)) == before
    assert gone_after_a_while(lambda: shuffle_files(spark) - shuffled)
    assert sorted((r.order_id, r.amount) for r in orders.read().collect()) == sorted(
        (f"O{i}", 11.0 if i >= 20 else 10.0) for i in range(60)
    )
    assert [r.total_orders for r in orders.metrics().collect()] == [60]


def test_shuffles_are_freed_inside_only_though_threads_and_calls_overlap(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, entered, left = spark.conf.get(name), threading.Event(), threading.Event()

    def other():
        with shuffles_freed(spark):
            entered.set()
            left.wait(20)

    thread = threading.Thread(target=other)
    with shuffles_freed(spark):
        thread.start()
        assert entered.wait(20)
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == "true"
    left.set()
    thread.join(20)
    assert spark.conf.get(name) == before


def test_passing_tables_go_also_after_a_failure_and_others_stay(spark):
    other = scratch_path(spark, "stays")
    with pytest.raises(ZeroDivisionError), passing_tables(spark) as written:
        spark.range(3).write.parquet(other)
        (file, *_) = written(spark.range(5), "goes").inputFiles()
        assert os.path.exists(file.removeprefix("file://"))
        raise ZeroDivisionError
    assert not os.path.exists(file.removeprefix("file://")) and spark.read.parquet(other).count() == 3
