from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def location(tmp_path):
    def at(name: str) -> str:
        return str(tmp_path / name)

    return at


TRANSACTION = {
    "transaction_id": "T1", "customer_id": "C1", "account_id": "A1", "merchant_id": "M1",
    "transaction_date": "2024-01-15", "transaction_timestamp": "2024-01-15 10:30:00", "amount": "100.00",
    "currency": "USD", "transaction_type": "PURCHASE", "status": "COMPLETED", "channel": "POS",
    "country_code": "US", "description": "a purchase",
}


@pytest.fixture(scope="session")
def transactions(spark):
    """Raw transactions from changes to one valid row."""
    from ledgerloom import schemas

    def build(*changes: dict):
        columns = [*schemas.BUSINESS_COLUMNS["transactions"], "_batch_id"]
        rows = [tuple((TRANSACTION | {"_batch_id": "B1"} | c)[n] for n in columns) for c in changes]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    return build


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="session")
def values():
    return rows
