from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from txnspark.session import ensure_checkpoint_dir, get_session

    session = get_session(
        "txnspark-tests",
        master="local[4]",
        spark_sql_shuffle_partitions=4,
        spark_driver_memory="4g",
        spark_driver_host="127.0.0.1",
        spark_sql_warehouse_dir=_scratch("warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


def _scratch(name: str) -> str:
    import tempfile

    return tempfile.mkdtemp(prefix=f"txnspark-{name}-")


@pytest.fixture()
def duck():
    import duckdb

    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        yield con
