"""Rows 20-26 and 37-40 on hand fixtures (FIXTURES.md section 3)."""

import datetime as dt
import random

from conftest import D, T, rows, warehouse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnscope import config as C
from returnscope.operators import analysis, quality
from returnscope.operators.asof import asof_forward_min

REL = C.RELEASE_DATE  # 2025-06-15

SEG_USERS = [
    (1, D("2025-05-01"), "android", "eu", "paid"),
    (2, D("2025-05-01"), "android", "eu", "ads"),  # channel_alias: ads and paid in one device/region
    (3, D("2025-05-01"), "ios", "us", "seo"),
    (4, D("2025-05-01"), None, "us", "seo"),  # null_segment
]


def asof_forward_min_join(
    probe: DataFrame, build: DataFrame, key: str, probe_ts: str, build_ts: str, out_col: str
) -> DataFrame:
    """Join formulation (left join on key and build_ts >= probe_ts, then
    MIN per probe row).  Emits every (probe, later build) pair of a key, so it
    is kept for tests on small inputs only."""
    b = build.select(F.col(key).alias("_k"), F.col(build_ts).alias("_bts"))
    cols = probe.columns
    j = probe.join(b, (probe[key] == b["_k"]) & (b["_bts"] >= probe[probe_ts]), "left")
    return j.groupBy(*cols).agg(F.min("_bts").alias(out_col))


def test_rr_before_after_boundaries(spark):
    orders = [
        ("b1", 1, T("2025-06-01 00:00:00"), 1, "paid"),
        ("b2", 1, T("2025-06-10 10:00:00"), 1, "paid"),
        ("b3", 1, T("2025-06-14 23:59:59"), 1, "refunded"),
        ("a1", 1, T("2025-06-15 00:00:00"), 1, "paid"),
        ("a2", 1, T("2025-06-30 00:00:00"), 1, "refunded"),
        ("x1", 1, T("2025-06-30 00:00:01"), 1, "paid"),  # after the range end (midnight)
        ("x2", 1, T("2025-05-31 23:59:59"), 1, "paid"),
    ]
    w = warehouse(spark, orders=orders)
    r = analysis.rr_before_after(w.orders_labelled).collect()[0].asDict()
    assert r == {
        "orders_before": 2,
        "refunds_before": 1,
        "return_rate_before": 50.0,
        "orders_after": 1,
        "refunds_after": 1,
        "return_rate_after": 100.0,
        "return_rate_pct_change_after_vs_before": 100.0,
    }


def test_rr_before_after_empty_period_is_null(spark):
    orders = [("a1", 1, T("2025-06-20 00:00:00"), 1, "refunded")]
    w = warehouse(spark, orders=orders)
    r = analysis.rr_before_after(w.orders_labelled).collect()[0]
    assert (r.orders_before, r.return_rate_before, r.orders_after, r.return_rate_after) == (None, None, 0, None)
    assert r.return_rate_pct_change_after_vs_before is None


def test_rr_segment_ab_window_and_aliases(spark):
    orders = [
        ("o1", 1, T("2025-05-15 12:00:00"), 1, "paid"),  # outside: 31 days before
        ("o2", 1, T("2025-05-16 12:00:00"), 1, "paid"),
        ("o3", 1, T("2025-06-01 12:00:00"), 1, "refunded"),
        ("o4", 1, T("2025-07-15 23:00:00"), 1, "paid"),
        ("o5", 1, T("2025-07-16 00:00:00"), 1, "refunded"),  # outside
        ("o6", 2, T("2025-06-20 00:00:00"), 1, "paid"),  # only an after period
        ("o7", 4, T("2025-06-01 00:00:00"), 1, "paid"),
        ("o8", 4, T("2025-06-02 00:00:00"), 1, "pending"),  # counts as a row, not an order
    ]
    w = warehouse(spark, users=SEG_USERS, orders=orders)
    got = rows(
        analysis.rr_segment_ab(w.orders_labelled, w.users),
        "device", "region", "channel", "channel_group", "orders_before", "refunds_before",
        "orders_after", "refunds_after", "return_rate_percent_before", "return_rate_percent_after", "delta_pp",
    )
    assert got == [
        ("Android", "EU", "Paid", "Paid", 1, 1, 1, 0, 100.0, 0.0, -100.0),
        ("Android", "EU", "ads", "Paid", None, None, 1, 0, None, 0.0, None),
        (None, "US", "seo", "Organic", 1, 0, None, None, 0.0, None, None),
    ]
    top = analysis.top_rr_growth(analysis.rr_segment_ab(w.orders_labelled, w.users), 1).collect()
    assert top[0].delta_pp == -100.0
    dev = rows(analysis.rr_by_dimension(w.orders_labelled, w.users, "device"), "device", "orders_before", "orders_after")
    assert dev == [("Android", 1, 2), (None, 1, None)]


def test_ztest_known_values(spark):
    import math

    df = spark.createDataFrame(
        [
            ("a", "r", "c", "Paid", 70, 1000, 157, 1000),
            ("b", "r", "c", "Paid", 50, 500, 50, 500),
            ("c", "r", "c", "Paid", 30, 20, 1, 10),
            ("d", "r", "c", "Paid", 0, 0, 5, 10),
        ],
        "device string, region string, channel string, channel_group string, refunds_before long, "
        "orders_before long, refunds_after long, orders_after long",
    )
    z = {r.device: r for r in analysis.rr_ztest(df).collect()}
    p = (70 + 157) / 2000
    zz = (0.07 - 0.157) / math.sqrt(p * (1 - p) * (1 / 1000 + 1 / 1000))
    assert abs(z["a"].z_stat - zz) < 1e-12
    assert abs(z["a"].p_value - math.erfc(abs(zz) / math.sqrt(2))) < 1e-13
    se = math.sqrt(0.07 * 0.93 / 1000 + 0.157 * 0.843 / 1000)
    assert abs(z["a"].ci_low_pp - (0.087 - 1.96 * se) * 100) < 1e-9
    assert abs(z["a"].delta_pp - 8.7) < 1e-9
    assert z["b"].z_stat == 0.0 and z["b"].p_value == 1.0
    assert z["c"].z_stat is None and z["c"].p_value is None and z["c"].ci_low_pp is None  # refunds > orders
    assert z["d"].z_stat is None and z["d"].return_rate_before is None  # zero orders


def test_checkout_funnel_skip_and_missing_cart(spark):
    events = [
        ("1", 1, T("2025-06-01 10:00:00"), "add_to_cart"),
        ("2", 1, T("2025-06-01 10:01:00"), "payment_success"),  # payment without checkout
        ("3", 3, T("2025-06-20 10:00:00"), "checkout_start"),  # no cart at all
        ("4", 3, T("2025-06-20 10:01:00"), "payment_success"),
    ]
    w = warehouse(spark, users=SEG_USERS, events=events)
    got = rows(analysis.checkout_funnel_before_after(w.events_labelled, w.dim_user), "device", "metric", "before", "after", "diff")
    assert got == [
        ("Android", "conv_cart_to_checkout_pct", 0.0, None, None),
        ("Android", "conv_checkout_to_payment_pct", None, None, None),
        ("Android", "refund_after_payment_pct", 0.0, None, None),
        ("iOS", "conv_cart_to_checkout_pct", None, None, None),
        ("iOS", "conv_checkout_to_payment_pct", None, 100.0, None),
        ("iOS", "refund_after_payment_pct", None, 0.0, None),
    ]


def test_d7_cohorts_window_and_zero_base(spark):
    users = [
        (1, D("2025-06-10"), "ios", "eu", "paid"),
        (2, D("2025-06-10"), "ios", "eu", "paid"),
        (3, D("2025-06-10"), "ios", "eu", "paid"),
        (4, D("2025-05-10"), "ios", "eu", "paid"),
    ]
    events = [
        ("1", 1, T("2025-06-10 00:00:00"), "view"),  # not a funnel step
        ("2", 1, T("2025-06-10 00:00:00"), "add_to_cart"),  # at reg_date: counts
        ("3", 2, T("2025-06-16 23:59:00"), "refund"),  # reg + 6 days 23:59: counts
        ("4", 3, T("2025-06-17 00:00:00"), "add_to_cart"),  # reg + 7 days: does not
        ("5", 4, T("2025-05-09 00:00:00"), "add_to_cart"),  # before registration
    ]
    w = warehouse(spark, users=users, events=events)
    r = analysis.d7_retention_cohorts(w.users, w.events_labelled).collect()[0].asDict()
    assert r == {
        "post_new_users_count": 3,
        "post_retained_users_count": 2,
        "post_d7_retention": 66.67,
        "pre_new_users_count": 1,
        "pre_retained_users_count": 0,
        "pre_d7_retention": 0.0,
        "delta_d7_retention": None,  # division by a zero base
    }
    exact = analysis.d7_retention_cohorts(w.users, w.events_labelled, mode="exact_day").collect()[0]
    assert (exact.post_new_users_count, exact.post_retained_users_count) == (3, 1)  # only the day-7 event


def test_rr_registration_cohort(spark):
    users = [
        (1, D("2025-05-20"), "ios", "eu", "paid"),
        (2, D("2025-06-15"), "ios", "eu", "paid"),
        (3, D("2025-06-20"), "ios", "eu", "paid"),
        (4, D("2025-06-05"), "ios", "eu", "paid"),  # in no cohort
    ]
    events = [
        ("1", 2, T("2025-07-14 23:59:59"), "refund"),  # reg + 29 days: inside
        ("2", 3, T("2025-07-20 00:00:00"), "refund"),  # reg + 30 days: outside
        ("3", 1, T("2025-05-25 00:00:00"), "add_to_cart"),
    ]
    w = warehouse(spark, users=users, events=events)
    r = analysis.rr_by_registration_cohort(w.users, w.events_labelled).collect()[0].asDict()
    assert r == {
        "pre_users": 1,
        "pre_refunded_users": 0,
        "pre_rr": 0.0,
        "post_users": 2,
        "post_refunded_users": 1,
        "post_rr": 50.0,
        "delta_rr": None,  # zero pre rate
    }


def test_quick_refunds_asof(spark):
    orders = [
        ("o1", 1, T("2025-06-16 10:00:00"), 1, "paid"),
        ("o2", 2, T("2025-06-16 10:00:00"), 1, "paid"),
        ("o3", 3, T("2025-06-16 10:00:00"), 1, "paid"),
        ("o4", 4, T("2025-06-16 08:00:00"), 1, "paid"),
        ("o5", 4, T("2025-06-16 09:00:00"), 1, "paid"),
        ("o6", 5, T("2025-06-16 09:00:00"), 1, "paid"),
        ("o7", 6, T("2025-06-14 09:00:00"), 1, "paid"),  # before the window
    ]
    events = [
        ("r0", 1, T("2025-06-16 09:00:00"), "refund"),  # before the order
        ("r1", 1, T("2025-06-16 10:00:00"), "refund"),  # at the order instant
        ("r2", 2, T("2025-06-17 10:00:00"), "refund"),  # exactly 24 h
        ("r3", 3, T("2025-06-17 10:00:01"), "returned"),  # 24 h + 1 s
        ("r4", 4, T("2025-06-16 12:00:00"), "chargeback"),  # serves two orders
        ("r5", 6, T("2025-06-16 12:00:00"), "refund"),
    ]
    w = warehouse(spark, orders=orders, events=events)
    r = analysis.quick_refund_share(w.orders_labelled, w.events_labelled).collect()[0].asDict()
    assert r == {"total_refunded_orders": 5, "refunded_within_24h": 4, "share_quick_refunds": 80.0}


def test_asof_window_equals_join_form_with_hot_key(spark):
    rnd = random.Random(7)
    base = dt.datetime(2025, 6, 15)
    probe, build = [], []
    for i in range(600):
        user = 0 if i % 3 == 0 else rnd.randint(1, 20)  # user 0 holds a third of the rows
        probe.append((f"o{i}", user, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))))
    for i in range(300):
        user = 0 if i % 3 == 0 else rnd.randint(1, 25)
        build.append((user, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))))
    probe.append(("null_ts", 1, None))
    probe.append(("null_user", None, base + dt.timedelta(hours=1)))
    p = spark.createDataFrame(probe, "order_id string, user_id int, order_date timestamp_ntz")
    b = spark.createDataFrame(build, "user_id int, refund_ts timestamp_ntz")
    fast = asof_forward_min(p, b, "user_id", "order_date", "refund_ts", "refund_ts")
    slow = asof_forward_min_join(p, b, "user_id", "order_date", "refund_ts", "refund_ts")
    assert rows(fast, "order_id", "user_id", "order_date", "refund_ts") == rows(
        slow, "order_id", "user_id", "order_date", "refund_ts"
    )


def test_cart_dropoff(spark):
    users = [
        (1, D("2025-05-01"), "ios", "eu", "paid"),
        (2, D("2025-05-01"), "ios", "eu", "paid"),
        (3, D("2025-05-01"), "android", "us", "seo"),
        (4, D("2025-05-01"), None, "us", "seo"),
    ]
    events = [
        ("1", 1, T("2025-06-01 00:00:00"), "add_to_cart"),
        ("2", 1, T("2025-06-01 00:10:00"), "payment_success"),
        ("3", 2, T("2025-06-01 00:00:00"), "add_to_cart"),
        ("4", 2, T("2025-06-20 00:10:00"), "payment_success"),  # paid in the other period
        ("5", 3, T("2025-06-20 00:00:00"), "add_to_cart"),
        ("6", 3, T("2025-06-20 00:05:00"), "payment_success"),  # all buy: segment absent
        ("7", 4, T("2025-06-20 00:00:00"), "add_to_cart"),  # NULL segment: absent
    ]
    w = warehouse(spark, users=users, events=events)
    got = rows(analysis.cart_dropoff(w.events_labelled, w.dim_user))
    assert got == [("before", "iOS", "EU", "Paid", 1, 2, 50.0)]
    kept = rows(analysis.cart_dropoff(w.events_labelled, w.dim_user, keep_zero=True))
    assert kept == [
        ("after", "Android", "US", "seo", 0, 1, 0.0),
        ("after", None, "US", "seo", 1, 1, 100.0),
        ("before", "iOS", "EU", "Paid", 1, 2, 50.0),
    ]
    for r in analysis.cart_dropoff(w.events_labelled, w.dim_user, keep_zero=True).collect():
        assert r.users_dropoff <= r.users_added_to_cart


def test_kpi_totals_and_funnel_by_month(spark):
    orders = [
        ("o1", 1, T("2025-06-01 10:00:00"), 1, "paid"),
        ("o2", 1, T("2025-06-08 10:00:00"), 1, "paid"),
        ("o3", 2, T("2025-06-03 10:00:00"), 1, "refunded"),
        ("o4", 2, T("2025-07-03 10:00:00"), 1, "paid"),  # outside the range
    ]
    events = [
        ("1", 1, T("2025-06-01 00:00:00"), "add_to_cart"),
        ("2", 1, T("2025-06-01 00:00:00"), "add_to_cart"),
        ("3", 1, T("2025-06-01 00:05:00"), "payment_success"),
        ("4", 2, T("2025-05-01 00:05:00"), "add_to_cart"),
        ("5", 2, T("2025-05-01 00:06:00"), "checkout_start"),
    ]
    w = warehouse(spark, orders=orders, events=events)
    k = quality.kpi_totals(w.orders_labelled, w.events_labelled).collect()[0].asDict()
    assert k == {
        "orders": 2,
        "refunds": 1,
        "return_rate_pct": 50.0,
        "conv_to_payment_pct": 50.0,
        "d7_retention_pct": 100.0,
    }
    m = rows(analysis.funnel_by_month(w.events_labelled))
    assert m == [(D("2025-05-01"), 100.0, 0.0, None), (D("2025-06-01"), 0.0, None, 0.0)]
    change = analysis.funnel_month_change(w.events_labelled, D("2025-05-15"), D("2025-06-01")).collect()
    assert {r.metric: (r.before, r.after, r.diff) for r in change} == {
        "conv_cart_to_checkout_pct": (100.0, 0.0, -100.0),
        "conv_checkout_to_payment_pct": (0.0, None, None),
        "refund_after_payment_pct": (None, 0.0, None),
    }
    none = analysis.funnel_month_change(w.events_labelled, D("2024-01-01"), D("2024-02-01")).collect()
    assert len(none) == 3 and all(r.before is None and r.after is None and r.diff is None for r in none)


def test_asof_single_hot_instant_is_split(spark):
    t = dt.datetime(2025, 6, 16, 12)
    probe = [(f"o{i}", 1, t) for i in range(200)] + [("early", 1, t - dt.timedelta(hours=1))]
    build = [(1, t)] * 100 + [(1, t + dt.timedelta(hours=2))]
    p = spark.createDataFrame(probe, "order_id string, user_id int, order_date timestamp_ntz")
    b = spark.createDataFrame(build, "user_id int, refund_ts timestamp_ntz")
    got = asof_forward_min(p, b, "user_id", "order_date", "refund_ts", "refund_ts", num_partitions=4)
    assert {r.refund_ts for r in got.collect()} == {t}
    assert got.count() == 201


def test_asof_large_input_partial_sampling(spark):
    """Enough rows that range bounds come from a partial sample: both passes
    of the operator must still see one partition numbering."""
    import bisect

    rnd = random.Random(11)
    base = dt.datetime(2025, 6, 15)
    probe = [(f"o{i}", 0 if i % 3 == 0 else rnd.randint(1, 500), base + dt.timedelta(seconds=rnd.randint(0, 10**6))) for i in range(20000)]
    build = [(0 if i % 3 == 0 else rnd.randint(1, 500), base + dt.timedelta(seconds=rnd.randint(0, 10**6))) for i in range(10000)]
    p = spark.createDataFrame(probe, "order_id string, user_id int, order_date timestamp_ntz").repartition(7)
    b = spark.createDataFrame(build, "user_id int, refund_ts timestamp_ntz").repartition(5)
    got = {r.order_id: r.refund_ts for r in asof_forward_min(p, b, "user_id", "order_date", "refund_ts", "refund_ts", num_partitions=16).collect()}
    by_user = {}
    for u, t in build:
        by_user.setdefault(u, []).append(t)
    for ts in by_user.values():
        ts.sort()
    for oid, u, t in probe:
        ts = by_user.get(u, [])
        i = bisect.bisect_left(ts, t)
        assert got[oid] == (ts[i] if i < len(ts) else None), oid


def test_asof_of_a_hot_key_is_linear(spark):
    """One user holds a third of the rows; the running minimum must not grow quadratically."""
    import time

    from returnscope.operators.asof import asof_forward_min

    def run(n):
        ts = F.to_timestamp_ntz(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % n))
        user = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("int")
        p = spark.range(n).select(user.alias("user_id"), "id", ts.alias("t"))
        b = spark.range(n // 10).select((F.lit(0) * F.col("id") - 1).cast("int").alias("user_id"), F.to_timestamp_ntz(F.timestamp_seconds(F.lit(1_700_000_005) + F.col("id") * 10)).alias("r"))
        start = time.perf_counter()
        got = asof_forward_min(p, b, "user_id", "t", "r", "first", num_partitions=4).agg(F.count("first"), F.count(F.lit(1))).first()
        return time.perf_counter() - start, got

    run(1000)
    small, _ = run(30_000)
    large, (found, total) = run(300_000)
    assert total == 300_000 and found > 99_000
    assert large < 10 * small + 15  # quadratic windows need minutes


def test_interval_join_equals_all_pairs_without_a_nested_loop(spark):
    import random

    from returnscope.operators.ranges import interval_join

    r = random.Random(8)
    day = lambda lo, hi: dt.date(2025, 1, 1) + dt.timedelta(days=r.randint(lo, hi))
    people = [(i, day(-400, 500)) for i in range(400)] + [(900, None), (901, day(0, 0)), (901, day(0, 0))]
    spans = []
    for i in range(1000):
        lo = day(-100, 300)
        spans.append((f"c{i}", lo, r.choice([None, lo, lo - dt.timedelta(days=3), lo + dt.timedelta(days=1), lo + dt.timedelta(days=r.randint(1, 200))])))
    spans += [("null", None, day(0, 9)), ("c0", *spans[0][1:])]
    users = spark.createDataFrame(people, "user_id int, reg_date date")
    cohorts = spark.createDataFrame(spans, "cohort string, start_date date, end_date date")
    want = sorted((u, c) for u, d in people for c, lo, hi in spans if d and lo and d >= lo and (hi is None or d < hi))
    for width in (1, 16, 400):
        got = interval_join(users, cohorts, "reg_date", "start_date", "end_date", width)
        assert sorted((x.user_id, x.cohort) for x in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "HashJoin" in plan or "SortMergeJoin" in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(users, cohorts.limit(0), "reg_date", "start_date", "end_date").count() == 0


def test_retention_of_overlapping_cohorts(spark):
    from returnscope.operators.analysis import retention_by_cohort

    start = dt.date(2025, 5, 1)
    people = [(i, start + dt.timedelta(days=i % 60), "ios", "eu", "paid") for i in range(120)]
    seen = [(f"e{i}", i, dt.datetime(2025, 5, 1) + dt.timedelta(days=i % 60 + i % 11, hours=3), "refund") for i in range(0, 120, 2)]
    w = warehouse(spark, people, events=seen)
    spans = [(f"c{i}", start + dt.timedelta(days=i), None if i % 9 == 0 else start + dt.timedelta(days=i + 1 + i % 30)) for i in range(50)]
    cohorts = spark.createDataFrame(spans, "cohort string, start_date date, end_date date")
    back = {u for _, u, t, _ in seen if 0 <= (t.date() - people[u][1]).days < 7}
    want = []
    for c, lo, hi in spans:
        mine = [u for u, d, *_ in people if d >= lo and (hi is None or d < hi)]
        want.append((c, len(mine), sum(u in back for u in mine), round(100 * sum(u in back for u in mine) / len(mine), 2)))
    df = retention_by_cohort(w.users, w.events_labelled, cohorts)
    assert rows(df, "cohort", "new_users_count", "retained_users_count", "d7_retention") == sorted(want)
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
