"""Keyed masks and their rotation; distinct sketches of runs."""

from __future__ import annotations

import hashlib
import hmac
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import keyed_mask
from sellerlens.operators import quality, rekey


@pytest.mark.parametrize("secret", [b"k", b"x" * 64, b"y" * 65, bytes(range(256)), b""])
def test_keyed_mask_is_hmac(spark, secret):
    ids = ["C1", "", "é日", "x" * 1_000, None]
    df = spark.createDataFrame([(i,) for i in ids], "c string").select("c", keyed_mask("c", secret).alias("m"))
    for r in df.collect():
        assert r.m == (None if r.c is None else hmac.new(secret, r.c.encode(), hashlib.sha256).hexdigest())


def test_a_customer_is_whole_again_after_rotation(spark, table):
    keys = [rekey.MaskKey(str(i), f"secret {i}".encode()) for i in range(3)]
    rows = [{"order_id": f"O{i}", "seller_id": "S", "customer_id": f"C{i % 5}" if i % 7 else None, "amount": 1.0} for i in range(60)]
    orders = table("refined.orders", *rows)
    parts = [rekey.mask_with_key(orders.where(F.substring("order_id", -1, 1).cast("int") % 3 == i), k) for i, k in enumerate(keys)]
    masked = reduce(DataFrame.unionByName, parts)
    assert "customer_id" not in masked.columns
    changes = reduce(DataFrame.unionByName, [rekey.rekey_map(orders, k, keys[2]) for k in keys[:2]])
    after = rekey.rekeyed(masked, changes, "2")
    assert after.columns == masked.columns and after.count() == len(rows)
    got = {(r.customer_id_masked): r["count"] for r in after.groupBy("customer_id_masked").count().collect()}
    want = {}
    for r in rows:
        m = r["customer_id"] and hmac.new(keys[2].secret, r["customer_id"].encode(), hashlib.sha256).hexdigest()
        want[m] = want.get(m, 0) + 1
    assert got == want
    assert {r.mask_key_id for r in after.where("customer_id_masked IS NOT NULL").select("mask_key_id").collect()} == {"2"}
    # What no map knows keeps its id and the name of its key.
    none = rekey.rekeyed(parts[0], changes.limit(0), "2")
    assert {r.mask_key_id for r in none.select("mask_key_id").collect()} == {"0"}
    assert sorted(none.collect()) == sorted(parts[0].collect())


def test_sketches_of_runs_merge_into_that_of_all_rows(spark):
    keys = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 0, F.concat(F.lit("O"), F.col("id") % 60_000)).alias("order_id"), F.col("id") % 3 == 0,
        (F.pmod(F.hash("id"), F.lit(3))).alias("run"),
    )
    sketches = [quality.key_sketch(keys.where(F.col("run") == i), "t", "order_id") for i in range(3)]
    (merged,) = quality.merged_duplicates(reduce(DataFrame.unionByName, sketches)).collect()
    (whole,) = quality.merged_duplicates(quality.key_sketch(keys, "t", "order_id")).collect()
    assert merged == whole
    exact = 200_000 - keys.select("order_id").distinct().count()
    assert abs(merged.duplicate_estimate - exact) <= merged.error_bound < 0.05 * 60_000
    (none,) = quality.merged_duplicates(quality.key_sketch(keys.limit(0), "t", "order_id")).collect()
    assert (none.total_rows, none.duplicate_estimate, none.error_bound) == (0, 0, 0)
