"""Scratch tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sellerlens.sources import pointers

_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Only a local master may do without that setting; it gets a temporary folder. On a cluster
    a machine-local folder would be lost, or not be seen by the other machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.conf.get("spark.app.id") in _local_roots:
        return _local_roots[spark.conf.get("spark.app.id")]
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    _local_roots[app] = tempfile.mkdtemp(prefix="sellerlens-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.conf.get("spark.app.id"), []).append(path)
    return path


def use_scratch(spark: SparkSession, folder: str) -> None:
    """Where scratch tables go if spark.checkpoint.dir is unset: a folder that all executors share."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        _local_roots[spark.conf.get("spark.app.id")] = folder.rstrip("/")


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables written inside, when the results have been written elsewhere."""
    made = _made.setdefault(spark.conf.get("spark.app.id"), [])
    before = len(made)
    try:
        yield
    finally:
        for path in made[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del made[before:]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet and read back: lineage is cut, sizes are known."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``materialize`` for tables that are needed inside only: they are deleted at the end, and no other thread's are."""
    made: list[str] = []

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        made.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield written
    finally:
        for path in made:
            pointers.remove(spark, path)
