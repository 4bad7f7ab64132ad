from __future__ import annotations

from pathlib import Path

import pytest

from jangbu.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(Path(tmp_path_factory.mktemp("shared")).as_uri())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in sorted(Path(SMALL).glob("*.parquet")):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))
