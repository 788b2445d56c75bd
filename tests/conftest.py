from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import local_session, release  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(8, partitions=4, spark__sql__warehouse__dir=str(folder / "warehouse"),
                            spark__checkpoint__dir=str(folder / "checkpoints"))
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from shelfline.plans.data import Data

    return Data(spark, SMALL)


@pytest.fixture
def one_series(spark):
    """Builds a one-series panel from a list of units, price 1."""

    def build(units, start=dt.date(2020, 1, 1)):
        rows = [
            ("I", "S", "C", "D", "CA", start + dt.timedelta(days=i), u, 1.0, float(u), int(u == 0)) for i, u in enumerate(units)
        ]
        return spark.createDataFrame(
            rows, "item_id string, store_id string, category_id string, department_id string, state_id string, date date, "
            "units_sold long, sell_price double, revenue double, zero_sales_flag int")

    return build
