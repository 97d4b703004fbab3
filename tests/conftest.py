import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pacecast.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=4, app_name="pacecast-tests")
    yield session
    session.stop()


def D(x) -> Decimal:
    return Decimal(str(x))


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


SERIES_SCHEMA = ("date date, feature int, measure int, period int, entity int, currency int, "
                 "value decimal(21,2), value_ptd decimal(31,2)")


def series_frame(spark, rows):
    """rows: (date str, feature, value, value_ptd) -> long series (measure etc. 0)."""
    data = [(day(d), f, 0, 0, 0, 0, None if v is None else D(v), None if p is None else D(p))
            for d, f, v, p in rows]
    return spark.createDataFrame(data, SERIES_SCHEMA)
