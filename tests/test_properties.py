"""Property tests against brute force on small random inputs."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from returnscope.operators import staging
from returnscope.operators.asof import asof_forward_min
from returnscope.sources import schemas

BASE = dt.datetime(2025, 6, 15)
# minutes spread over several one-hour slices, with repeats
times = st.one_of(st.none(), st.integers(0, 300).map(lambda m: BASE + dt.timedelta(minutes=m)))
keys = st.one_of(st.none(), st.integers(0, 3), st.just(0))  # key 0 is hot

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    probe=st.lists(st.tuples(keys, times), min_size=1, max_size=25),
    build=st.lists(st.tuples(keys, times), max_size=25),
)
def test_asof_matches_brute_force(spark, probe, build):
    p = spark.createDataFrame(
        [(f"o{i}", k, t) for i, (k, t) in enumerate(probe)], "order_id string, user_id int, order_date timestamp_ntz"
    )
    b = spark.createDataFrame(build, "user_id int, refund_ts timestamp_ntz")
    got = rows(asof_forward_min(p, b, "user_id", "order_date", "refund_ts", "refund_ts"), "order_id", "refund_ts")
    expected = []
    for i, (k, t) in enumerate(probe):
        later = [bt for bk, bt in build if k is not None and bk == k and t is not None and bt is not None and bt >= t]
        expected.append((f"o{i}", min(later) if later else None))
    assert got == sorted(expected, key=lambda r: (r[0], r[1] is None, r[1] or BASE))


orders = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.one_of(st.none(), st.integers(1, 3)),
    times,
    st.one_of(st.none(), st.sampled_from([Decimal("-1.00"), Decimal("0.00"), Decimal("5.00"), Decimal("999999.99")])),
    st.sampled_from(["Paid", "paid", "REFUNDED", None]),
)


@SETTINGS
@given(raw=st.lists(orders, max_size=20))
def test_orders_dedup_matches_brute_force(spark, raw):
    df = spark.createDataFrame(raw, schemas.ORDERS_RAW)
    got = rows(staging.stg_orders_clean(df), "order_id", "user_id", "order_date", "amount", "status")

    def key(r):  # ascending, NULLs last, on (order_date, user_id, amount, status)
        return tuple((v is None, v if v is not None else 0) for v in r[1:])

    best = {}
    for oid, uid, ts, amount, status in raw:
        if amount is None or amount < 0:
            continue
        row = (oid, ts, uid, amount, status.lower() if status else None)
        if oid not in best or key(row) < key(best[oid]):
            best[oid] = row
    expected = sorted(
        ((r[0], r[2], r[1], r[3], r[4]) for r in best.values()),
        key=lambda t: tuple((x is None, x if x is not None else 0) for x in t),
    )
    assert got == expected
