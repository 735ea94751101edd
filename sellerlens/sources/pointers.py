"""Logs of names in the shared file system, whose last entry is what holds now.

An entry is a small text file of its own, written beside the log and renamed into it, so a reader sees it
whole or not at all. Listing a log needs no Spark job; SQL reads it as a text table.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

_SUFFIX = ".txt"
_STAMP = "%Y%m%dT%H%M%S%f"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def stamp(moment: datetime | None = None) -> str:
    """A moment as a string that sorts by time, now if none is given."""
    return (moment or datetime.now(UTC)).strftime(_STAMP)


def later_than(last: str | None) -> str:
    """A stamp of now, or right after ``last`` where the clock of another machine was ahead."""
    now = stamp()
    if last is None or now > last:
        return now
    return stamp(datetime.strptime(last, _STAMP).replace(tzinfo=UTC) + timedelta(microseconds=1))


def ensure_folder(spark: SparkSession, path: str) -> None:
    _files(spark, path).mkdirs(_path(spark, path))


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system its path names."""
    _files(spark, path).delete(_path(spark, path), True)


def entries(spark: SparkSession, log: str) -> list[str]:
    """The entries of a log in their order, which is that of their names."""
    if not exists(spark, log):
        return []
    found = [s.getPath().getName() for s in _files(spark, log).listStatus(_path(spark, log))]
    return sorted(n.removesuffix(_SUFFIX) for n in found if n.endswith(_SUFFIX) and n[0] not in "._")


def add_entry(spark: SparkSession, log: str, entry: str) -> None:
    """Make ``entry`` part of the log in one step."""
    ensure_folder(spark, log)
    files = _files(spark, log)
    hidden, shown = (_path(spark, f"{log}/{name}") for name in (f"_{entry}", f"{entry}{_SUFFIX}"))
    out = files.create(hidden, True)
    out.write(bytearray(entry.encode()))
    out.close()
    if not files.rename(hidden, shown) and not files.exists(shown):
        raise OSError(f"cannot add {entry} to {log}")


def remove_entry(spark: SparkSession, log: str, entry: str) -> None:
    remove(spark, f"{log}/{entry}{_SUFFIX}")
