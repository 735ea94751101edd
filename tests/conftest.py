from __future__ import annotations

import pytest

from sellerlens.session import build_session

AS_OF = "2026-04-28 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows as dicts to a DataFrame with the named table's schema; missing fields are null."""
    from sellerlens.schemas import schema

    def build(name: str, *rows: dict):
        shape = schema(name)
        return spark.createDataFrame([tuple(r.get(f.name) for f in shape) for r in rows], shape)

    return build


def dicts(df):
    return [row.asDict() for row in df.collect()]


def by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
