from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from sellerlens.checks import registry
from sellerlens.checks.marts import marts
from sellerlens.operators.normalize import normalize_orders
from sellerlens.schemas import columns
from sellerlens.sources.files import Lake, export_json, read_json_lines, read_raw
from sellerlens.sources.scratch import scratch_root
from sellerlens.streaming.encode import encode_events
from sellerlens.streaming.ingest import file_topic, ingest_stream, landable
from tests.conftest import by, dicts


@pytest.fixture
def topic(tmp_path):
    path = tmp_path / "topic"
    path.mkdir()

    def send(name: str, *messages: str) -> str:
        (path / name).write_text("".join(m + "\n" for m in messages))
        return str(path)

    return send


def order(i: int) -> str:
    return json.dumps({"order_id": f"O{i}", "seller_id": "S1", "amount": i + 0.5})


def drain(spark, source, lake, table="orders"):
    ingest_stream(
        file_topic(spark, source, max_files_per_trigger=1),
        lake.stream_path(table),
        f"{lake.base}/offsets/{table}",
    ).awaitTermination()


def test_micro_batches_land_what_a_batch_read_sees(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for n in range(3):
        source = topic(f"{n}.json", *[order(10 * n + i) for i in range(5)])
    drain(spark, source, lake)
    batch = read_json_lines(spark, source, "orders").drop("_corrupt_record")
    landed = read_raw(spark, lake, "orders").drop("_corrupt_record")
    assert sorted(map(str, landed.collect())) == sorted(map(str, batch.collect()))


def test_restart_adds_nothing_and_new_messages_once(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    source = topic("a.json", order(1), order(2))
    drain(spark, source, lake)
    drain(spark, source, lake)
    assert read_raw(spark, lake, "orders").count() == 2
    topic("b.json", order(3))
    drain(spark, source, lake)
    assert sorted(r.order_id for r in read_raw(spark, lake, "orders").collect()) == [
        "O1", "O2", "O3",
    ]


def test_empty_messages_are_skipped_and_others_land_unparsed(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    source = topic("a.json", order(1), "null", "", "   ", '{"broken": ')
    drain(spark, source, lake)
    text = spark.read.text(lake.stream_path("orders"))
    assert sorted(r.value for r in text.collect()) == sorted([order(1), '{"broken": '])


def test_one_message_stays_on_one_line(spark):
    pretty = '{\n  "order_id": "O1"\r\n}'
    (row,) = landable(spark.createDataFrame([(pretty,), (None,)], "value STRING")).collect()
    assert "\n" not in row.value and json.loads(row.value) == {"order_id": "O1"}


def test_landed_files_and_streams_make_one_raw_table(spark, topic, tmp_path, table):
    lake = Lake(str(tmp_path / "lake"))
    export_json(
        table("raw.orders", {"order_id": "O1", "seller_id": "S1", "amount": "3"}),
        lake.path("raw", "orders"),
    )
    drain(spark, topic("a.json", order(1), order(2)), lake)
    raw = read_raw(spark, lake, "orders")
    assert raw.count() == 3
    assert normalize_orders(raw).count() == 2


def test_returns_topic(spark, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drain(spark, topic("a.json", '{"return_id": "R1", "seller_id": "S1"}'), lake, "returns")
    assert dicts(read_raw(spark, lake, "returns"))[0]["return_id"] == "R1"


@pytest.mark.parametrize(
    ("kind", "expected"),
    [
        ("orders", {"amount": 0.0, "status": "completed", "category": "electronics"}),
        ("returns", {"reason": "damaged_item", "status": "approved"}),
        ("complaints", {"severity": "medium", "category": "poor_quality"}),
    ],
)
def test_encoding_fills_defaults(table, kind, expected):
    (row,) = encode_events(table(f"raw.{kind}", {"seller_id": "S1"}), kind).collect()
    message = json.loads(row.value)
    assert list(message) == columns(f"raw.{kind}")
    assert message["seller_id"] == "S1" and message["timestamp"] is None
    assert {k: message[k] for k in expected} == expected


def test_encoding_keeps_what_is_there_and_can_be_keyed(table):
    raw = table("raw.orders", {"order_id": "O1", "seller_id": "S1", "amount": "12", "status": "x"})
    row = by(encode_events(raw, "orders", key="seller_id"), "key")["S1"]
    message = json.loads(row["value"])
    assert (message["amount"], message["status"]) == (12.0, "x")


def test_an_unreadable_amount_is_sent_as_it_is(table):
    rows = [
        {"order_id": i, "seller_id": "S1", "amount": a}
        for i, a in (("1", "abc"), ("2", None), ("3", " 7.25 "), ("4", ""))
    ]
    sent = [json.loads(r.value) for r in encode_events(table("raw.orders", *rows), "orders").collect()]
    assert {m["order_id"]: m["amount"] for m in sent} == {"1": "abc", "2": 0.0, "3": 7.25, "4": ""}


def test_encoded_events_read_back_as_the_same_rows(spark, table, tmp_path):
    raw = table(
        "raw.complaints",
        {"complaint_id": 'quo"te', "seller_id": "Sé", "timestamp": "t", "severity": "low",
         "category": "a\nb"},
    )
    encode_events(raw, "complaints").write.text(str(tmp_path / "events"))
    back = read_json_lines(spark, str(tmp_path / "events"), "complaints").drop("_corrupt_record")
    assert back.collect() == raw.collect()


def test_streamed_orders_take_two_micro_batches_and_leave_topic_raw_and_history(spark, table, tmp_path):
    m, scratch = marts(spark, str(tmp_path)), scratch_root(spark)
    rows = [
        {"order_id": f"O{i % 50}", "seller_id": f"S{i % 4}", "amount": str(i + 1.5), "timestamp": f"1999-01-{1 + i % 28:02d}T00:00:00"}
        for i in range(80)
    ]
    m._raw["orders"] = table("raw.orders", *rows).withColumn("amount", F.col("amount").cast("double"))
    os.makedirs(scratch, exist_ok=True)
    before = set(os.listdir(scratch))
    want = normalize_orders(read_back(encode_events(registry._corrected_orders(m), "orders"), spark, tmp_path))
    assert sorted(map(str, registry.streamed_orders(m).collect())) == sorted(map(str, want.collect()))
    made = {name.rsplit("-", 1)[0]: f"{scratch}/{name}" for name in set(os.listdir(scratch)) - before}
    assert set(made) == {"topic", "offsets", "seen", "streamed"}
    versions = [f for f in os.listdir(f"{made['streamed']}/history/orders/versions") if f.endswith(".txt")]
    assert sorted(f.split("=")[1] for f in versions) == ["stream-0.txt", "stream-1.txt"]
    sent = spark.read.text(made["topic"]).count()
    assert sent == registry._corrected_orders(m).count() == spark.read.text(f"{made['streamed']}/raw_stream/orders").count()


def read_back(messages, spark, tmp_path):
    messages.write.text(str(tmp_path / "events"))
    return read_json_lines(spark, str(tmp_path / "events"), "orders").drop("_corrupt_record")
