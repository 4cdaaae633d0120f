from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def table(spark):
    """Rows of one business table as a frame with the declared schema; columns not given are NULL."""
    import datetime
    from decimal import Decimal

    from ledgerloom.sources.schemas import struct

    def convert(value, kind):
        if value is None:
            return None
        if kind == "date" and isinstance(value, str):
            return datetime.date.fromisoformat(value)
        if kind.startswith("decimal"):
            return Decimal(str(value))
        if kind == "double":
            return float(value)
        return value

    def make(name: str, *rows: dict):
        schema = struct(name)
        unknown = {k for r in rows for k in r} - set(schema.fieldNames())
        assert not unknown, f"{name} has no columns {unknown}"
        data = [tuple(convert(r.get(f.name), f.dataType.simpleString()) for f in schema.fields) for r in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def tables(table):
    """A set of tables from rows; tables not given are empty."""
    from ledgerloom import Tables
    from ledgerloom.sources.schemas import TABLES

    def make(**rows: list[dict]):
        return Tables(lambda name: table(name, *rows.get(name, [])) if name in TABLES else None)

    return make
