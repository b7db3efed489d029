from __future__ import annotations

from datetime import datetime

import pytest

from cargolake.config import build_session

RUN_TS = datetime(2025, 3, 1, 8, 30, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """All rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
