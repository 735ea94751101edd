from __future__ import annotations

import hashlib
import json
import os

import pytest

from sellerlens.__main__ import VIEWS, main
from sellerlens.plans.pipeline import Run
from sellerlens.sources.scratch import scratch_root
from tests.test_files import ORDER, lake  # noqa: F401


@pytest.fixture(autouse=True)
def sizes_restored(spark):
    """Jobs size the session, which other tests share."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_jobs(spark, lake, tmp_path, capsys):  # noqa: F811
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text(json.dumps({**ORDER, "order_id": "O77"}) + "\n")
    late = tmp_path / "late.json"
    late.write_text('{"complaint_id": "CMP2", "seller_id": "S58", "severity": "high"}\n')
    base = ["--base", lake.base]
    main(["ingest", *base, "--table", "orders", "--folder", str(topic), "--max-per-trigger", "1"])
    main(["land", *base, "--table", "complaints", "--source", str(late)])
    main(["pipeline", *base, "--as-of", "2026-04-28", "--export", str(tmp_path / "out")])
    assert "curated.seller_risk" in capsys.readouterr().out
    for view in VIEWS:
        main(["show", view, *base, "--seller", "S58"])
        assert "+--" in capsys.readouterr().out
    main(["show", "profile", *base, "--seller", "S58", "--json", str(tmp_path / "profile")])
    row = spark.read.json(str(tmp_path / "profile")).first()
    assert (row.total_orders, row.total_complaints) == (4, 2)


def test_jobs_are_sized_and_leave_no_scratch(spark, lake, tmp_path, capsys):  # noqa: F811
    base = ["--base", lake.base]
    main(["pipeline", *base, "--as-of", "2026-04-28", "--input-bytes", str(100 * 2**40)])
    assert spark.conf.get("spark.sql.shuffle.partitions") == "40000"
    kept = set(os.listdir(scratch_root(spark)))
    main(["show", "priorities", *base])
    main(["show", "region-members", *base])
    assert set(os.listdir(scratch_root(spark))) == kept
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    main(["register", *base, "--prefix", "cli_"])
    assert "seller_risk" in capsys.readouterr().out
    assert spark.table("`cli_refined`.orders").count() > 0
    (tmp_path / "salt").write_text("pepper\n")
    main(["show", "customers", *base, "--salt-file", str(tmp_path / "salt"), "--json", str(tmp_path / "c")])
    digests = {r.customer_id_masked for r in spark.read.json(str(tmp_path / "c")).collect()}
    ids = {r.customer_id for r in Run(spark, lake).read("refined.orders").collect()}
    assert digests == {hashlib.sha256(f"pepper{i}".encode()).hexdigest() for i in ids}


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["fly"])
