from __future__ import annotations

import datetime as dt
import decimal

import pytest

from turnero.session import build_session
from turnero.sources.schemas import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark_sql_shuffle_partitions": "8", "spark_ui_enabled": "false", "spark_driver_memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make("reserva", [{...}, ...]): rows of a table from literals; absent columns take plain fillers."""
    filler = {"text": "x", "uuid": "x", "bool": True, "int": 1, "minutes": 0, "money": decimal.Decimal(1),
              "instant": dt.datetime(2026, 1, 1), "date": dt.date(2026, 1, 1)}

    def build(table: str, rows: list[dict]):
        spec = TABLES[table]
        data = []
        for row in rows:
            unknown = set(row) - set(spec.names())
            assert not unknown, unknown
            data.append(tuple(row.get(c.name, None if c.nullable else filler[c.kind]) for c in spec.columns))
        return spark.createDataFrame(data, spec.schema())
    return build


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
