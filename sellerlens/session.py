"""Session defaults the library relies on."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_MB = 1024 * 1024


def sized_for(input_bytes: int) -> dict[str, str]:
    """Scan and shuffle sizes for a run over ``input_bytes`` of raw data, for ``build_session``.

    Adaptive execution merges small shuffle partitions but splits large ones only in skewed
    joins, so the number to start from has to fit the data. It is bounded, as is the number
    of scan tasks: the driver keeps track of every (map task, reduce task) pair, and 100 TB in
    128 MB pieces on both sides would be too many. Larger partitions sort with spills instead.
    """
    split = min(max(128 * _MB, input_bytes // 100_000), 1024 * _MB)
    partitions = min(max(200, input_bytes // (256 * _MB)), 40_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def size_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Set a running session's scan and shuffle sizes for so much input, before its first plan."""
    for key, value in sized_for(input_bytes).items():
        spark.conf.set(key, value)
    return spark


def widen_shuffles(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Raise a running session's number of shuffle partitions to fit so much Parquet input; it is never lowered.

    A sorted row takes some twenty times its bytes in a Parquet file. With a number that does not grow with the input
    a partition outgrows a task's memory at some size, and from there on every sort and aggregation spills.
    """
    wanted = min(input_bytes // (8 * _MB), 40_000)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
# Of each session that is inside: how often, and its setting before.
_inside: dict[int, tuple[int, str]] = {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver comes to collect its garbage.

    For work in many queries, whose shuffles would else lie on the disks side by side. A DataFrame that is run
    again inside shuffles again. A stream that is started inside keeps to it.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        depth, before = _inside.get(session, (0, spark.conf.get(_FREED, "false")))
        _inside[session] = (depth + 1, before)
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            depth, before = _inside.pop(session)
            if depth > 1:
                _inside[session] = (depth - 1, before)
            else:
                spark.conf.set(_FREED, before)


def build_session(app: str = "sellerlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution on; ``conf`` overrides win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event timestamps carry no zone, so every reader has to agree on one."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
