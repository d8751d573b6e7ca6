import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from returnscope.plans.layers import Warehouse  # noqa: E402
from returnscope.session import local_session  # noqa: E402
from returnscope.sources import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="returnscope-tests")
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def M(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def users_df(spark, rows):
    return spark.createDataFrame(rows, schemas.USERS_RAW)


def orders_df(spark, rows):
    return spark.createDataFrame([(o, u, t, M(a), s) for o, u, t, a, s in rows], schemas.ORDERS_RAW)


def events_df(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS_RAW)


def warehouse(spark, users=(), orders=(), events=(), comments=None, params=None):
    from returnscope import config as C

    return Warehouse(
        users_df(spark, list(users)),
        orders_df(spark, list(orders)),
        events_df(spark, list(events)),
        comments,
        params or C.Params(),
    )


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(
        (tuple(r[c] for c in cols) for r in df.collect()),
        key=lambda t: tuple((x is None, x if x is not None else 0) for x in t),
    )
