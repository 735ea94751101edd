"""Masked customer ids under secrets that change.

A masked table names the key of each row's id. When a secret is to go, a trusted job that can see the ids makes a map
from old to new masked ids; with it old tables, and views over several keys, follow without seeing any id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerlens.functions import keyed_mask


@dataclass(frozen=True)
class MaskKey:
    """A secret and the name that masked rows give it."""

    key_id: str
    secret: bytes


def mask_with_key(df: DataFrame, key: MaskKey) -> DataFrame:
    """customer_id replaced by customer_id_masked and mask_key_id, the last columns; null ids stay null."""
    return df.withColumns(
        {"customer_id_masked": keyed_mask("customer_id", key.secret), "mask_key_id": F.lit(key.key_id)}
    ).drop("customer_id")


def rekey_map(customers: DataFrame, old: MaskKey, new: MaskKey) -> DataFrame:
    """(mask_key_id, customer_id_masked, new_masked), a row for each different id; customers come with their ids."""
    ids = customers.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    return ids.select(
        F.lit(old.key_id).alias("mask_key_id"),
        keyed_mask("customer_id", old.secret).alias("customer_id_masked"),
        keyed_mask("customer_id", new.secret).alias("new_masked"),
    )


def rekeyed(masked: DataFrame, changes: DataFrame, new_key_id: str) -> DataFrame:
    """``masked`` with the ids that ``changes`` knows under the new key; other rows keep theirs, and its name.

    A shuffled join: there are as many changes as customers. Each id has one change, so no row is doubled, and
    a customer with very many rows is split by adaptive execution.
    """
    found = masked.join(changes, ["mask_key_id", "customer_id_masked"], "left").withColumns(
        {
            "customer_id_masked": F.coalesce("new_masked", "customer_id_masked"),
            "mask_key_id": F.when(F.col("new_masked").isNotNull(), new_key_id).otherwise(F.col("mask_key_id")),
        }
    )
    return found.select(masked.columns)
